"""Preference formatting, the pipeline and the registered queries."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from staylake.llm import preference
from staylake.llm.queries import ORACLES, QUERIES
from tests.check import differences, duck
from tests.llm import brute

TURNS = "conv_id bigint, turn int, role string, text string"


def render(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_preferences(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"),
        (2, 1, "assistant", "no é"), (2, 0, "user", "hi"), (2, 2, "user", None),
        (5, 0, "user", "hi"), (5, 1, "assistant", "yes"),
        (6, 0, "user", "other"), (6, 1, "assistant", "well"),
        (None, 0, "user", "hi"), (8, None, None, "x"),
    ]
    got = {(r["chosen_id"], r["rejected_id"]): r for r in preference.preferences(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(got) == {(1, 2), (1, 5), (5, 6)}
    r = got[1, 2]
    assert r["n_common"] == 1 and r["prompt"] == render([("user", "hi")])
    assert r["chosen"] == render([("assistant", "yes")]) and r["chosen_mask"] == "0:14,1:3,0:8"
    assert r["rejected"] == render([("assistant", "no é"), ("user", "")]) and r["rejected_mask"] == "0:14,1:4,0:8,0:9,0:0,0:8"
    assert (got[1, 5]["chosen"], got[1, 5]["rejected"], got[1, 5]["n_common"]) == ("", "", 2)
    assert got[5, 6]["rejected"] == render([("assistant", "well")]) and got[5, 6]["prompt"] == render([("user", "hi")])
    assert preference.preferences(spark.createDataFrame([], TURNS)).collect() == []


def test_each_answered_conversation_has_a_row(spark):
    """Ids with gaps, user turns behind the answer, more conversations than buckets, and a single one."""
    rows = [(i * 1000 + 7, k, role, f"{role}{i}.{k}") for i in range(600) for k, role in enumerate(["user", "assistant", "user"][: 1 + i % 3])]
    turns = spark.createDataFrame(rows, TURNS)
    got = preference.all_preferences(turns).collect()
    answered = {i * 1000 + 7 for i in range(600) if i % 3}
    assert sorted(r["chosen_id"] for r in got) == sorted(answered) == sorted(r["rejected_id"] for r in got)
    for r in got:
        i, j = r["chosen_id"] // 1000, r["rejected_id"] // 1000
        assert i != j and r["n_common"] == 1 and r["prompt"] == render([("user", f"user{i}.0")])
        assert r["chosen"] == render([("assistant", f"assistant{i}.1")]) and r["rejected"] == render([("assistant", f"assistant{j}.1")])
    one = preference.all_preferences(turns.where("conv_id = 1007")).collect()
    assert [(r["chosen_id"], r["rejected_id"], r["n_common"], r["rejected"]) for r in one] == [(1007, 1007, 2, "")]
    assert preference.all_preferences(turns.limit(0)).collect() == []


def test_all_are_registered():
    names = queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).toArrow()
    assert differences(got, duck(sf).sql(ORACLES[name]).to_arrow_table()) == []


def test_columns_of_the_contracts(spark, sf):
    want = {
        "op1": "doc_id n_shingles component_id", "op3": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op4": "doc_id n_bytes n_removed n_spans kept_sha256", "op6": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op7": "doc_id n_tokens ids_sha256 decoded_sha256", "op8": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op9": "page_id host path rule verdict", "op10": "doc_id n_bytes n_tokens over_limit",
    }
    longs = "n_|component_id|doc_id"
    for name, run in QUERIES.items():
        if (op := name.split("_")[0]) in want and op not in ("op1", "op3", "op4"):  # those have tests that run them
            frame = run(spark, sf)
            assert set(want[op].split()) <= set(frame.columns)
            assert all(t == "bigint" for c, t in frame.dtypes if c.startswith(tuple(longs.split("|"))))


@pytest.fixture(scope="module")
def folder(spark, docs, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    items = [(1, " ".join(texts[54].split(" ")[3:20])), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_beside_brute_force(spark, folder, texts):
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}

    def good(text):
        words, _, symbols, _, _, repeated = brute.quality(text)
        return words >= 50 and 100 * repeated <= 50 * words and 5 * symbols <= words

    kept = {i: t for i, t in texts.items() if good(t)}
    group = brute.groups(kept, 5, 80)
    kept = {i: t for i, t in kept.items() if group[i][1] == i}
    hit = brute.passages(kept, [(1, " ".join(texts[54].split(" ")[3:20]))])
    kept = {i: t for i, t in kept.items() if not hit[i][1]}
    assert set(rows) == set(kept) and 0 < len(kept) < len(texts)
    assert all(rows[i]["text"] == t for i, t in kept.items() if not brute.secrets(t))
    assert all(len(rows[i]["ids"]) == 4 * rows[i]["n_tokens"] for i in kept)


def test_stages_on_odd_tables(spark, folder, docs):
    """Nulls in every column, repeated rows, further columns, no rows."""
    odd = docs.where("doc_id in (5, 54, 60, 63, 76)").union(docs.where("doc_id = 5"))
    odd = odd.withColumn("hits", F.lit(1)).unionByName(odd.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("hits", F.lit(None)))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == odd.columns and out.dtypes == odd.dtypes
        assert out.count() <= odd.count()
        assert stage(spark, odd.limit(0), folder).count() == 0


def test_near_duplicates_keep_documents_without_an_id_and_one_of_repeated_rows(spark, folder):
    a, b, c = ("".join(f"{x}{i} " for i in range(60)) for x in "abc")
    rows = [(1, a, "p", 1), (1, a, "o", 1), (None, b, None, 1), (2, a, "p", 1), (4, c, "p", 2), (None, b, "q", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, place0 int")
    out = corpus_pipeline.near_duplicates(spark, frame, folder)
    assert out.columns == frame.columns
    got = sorted((r["doc_id"] or 0, r["text"], r["source"] or "") for r in out.collect())
    assert [(i, t) for i, t, _ in got] == [(0, b), (1, a), (4, c)] and got[1][2] == "o"


def test_another_answer_in_an_early_place_ends_the_rejected_side(spark, monkeypatch):
    """Each conversation has a row for its last and one for its first answer; small buckets give the same order."""
    rows = [(i, k, role, f"{role}{i}.{k}") for i in range(1, 30) for k, role in enumerate(["user", "assistant", "user", "assistant", "user"])]
    turns = spark.createDataFrame(rows, TURNS)
    got = preference.all_preferences(turns).collect()
    assert sorted((r["chosen_id"], r["n_common"]) for r in got) == sorted((i, n) for i in range(1, 30) for n in (1, 3))
    for r in got:
        i, j, n = r["chosen_id"], r["rejected_id"], r["n_common"]
        whole = [("user", f"user{i}.0"), ("assistant", f"assistant{i}.1"), ("user", f"user{i}.2"), ("assistant", f"assistant{i}.3")]
        assert i != j and r["prompt"] == render(whole[:n]) and r["chosen"] == render(whole[n:])
        assert r["rejected"] == render([("assistant", f"assistant{j}.3")])
    monkeypatch.setattr(preference, "BUCKET", 2)
    again = preference.all_preferences(turns).collect()
    assert sorted((r["chosen_id"], r["rejected_id"]) for r in again) == sorted((r["chosen_id"], r["rejected_id"]) for r in got)
