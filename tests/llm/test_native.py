"""Rules, personal data, secrets and urls: expressions only, beside brute force."""

import re

import pytest
from pyspark.sql import functions as F

from staylake.llm import pii, rules, secrets, urls
from tests.llm import brute


def test_measures_and_policies(docs, nothing, texts):
    rows = rules.ledger(docs).withColumn("kept", rules.enforced("v1") == 0).collect()
    assert {r["doc_id"]: tuple(r[m] for m in rules.MEASURES) for r in rows} == {i: brute.quality(t) for i, t in texts.items()}
    for r in rows:
        few, many = r["n_words"] < 50, 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert (r["failed"] & 3 != 0) == (few or many)
        assert r["kept"] == (not few and not many and 5 * r["n_symbols"] <= r["n_words"])
    assert rules.ledger(nothing).collect() == []


def test_passing_keeps_rows_as_they_are(docs):
    kept = {r["doc_id"] for r in rules.ledger(docs).where(rules.enforced("v1") == 0).collect()}
    rows = rules.passing(docs.union(docs), "v1")
    assert rows.columns == docs.columns
    assert sorted(r["doc_id"] for r in rows.collect()) == sorted([*kept, *kept])


def test_ablations_read_the_ledger(docs):
    rows = rules.ledger(docs).collect()
    got = {r["rule"]: (r["n_failed"], r["n_only"]) for r in rules.ablations(rules.ledger(docs), "v2").collect()}
    mask = rules.policy_mask("v2")
    for k, rule in enumerate(rules.RULES):
        assert got[rule] == (sum(r["failed"] >> k & 1 for r in rows), sum(r["failed"] & mask == 1 << k for r in rows))


@pytest.fixture(scope="module")
def model(docs):
    labelled = docs.sparkSession.range(200).selectExpr(
        "id AS doc_id",
        """CASE id % 4 WHEN 0 THEN concat('mail u', id, '@site', id, '.org or @home') WHEN 1 THEN concat('ip 10.0.', id, '.7 v1.2.', id)
        WHEN 2 THEN concat('call +49 30 12345', id, ' or 030 ', id, '123 45') ELSE concat('u@h ', id, ' 4111 1111 1111 1111 or 4111 1111 1111 ', 1000 + id) END AS text""",
    )
    return pii.fit(labelled, documents=200, precision=0.9)


def test_personal_data(docs, nothing, texts, model):
    found = pii.report(pii.find(docs, model))
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute.personal(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == brute.sha(",".join(base))
        assert set(base) <= set(r["spans"].split(","))
    assert pii.report(pii.find(nothing, model)).collect() == []
    assert pii.fit(nothing).trees == {}


def test_forests_tell_candidates_apart(spark, model):
    assert "email" in model.trees and 0 < model.threshold["email"] <= 1
    text = "write to someone@host.net today"
    rows = spark.createDataFrame([(1, text), (2, "meet @ noon")], "doc_id int, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(pii.find(rows, model)).collect()}
    assert got[1].split(",")[0] == "email:9:25" and got[2] == ""


def test_finds_what_the_base_patterns_miss(spark):
    texts = {
        "phone": "please call (212) 555-1234 today", "local": "Tel. 030 1234567", "abroad": "Phone: 0049 30 1234567",
        "email": "write to jonas@grün-haus.de today", "card": "card 4111.1111.1111.1111 was used",
        "version": "version 10.15.7.2024 is out", "date": "call on 2024-01-15 or 15.01.2024", "order": "order 2024001234 shipped", "home": "we are @home or me@work",
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    found = pii.report(pii.find(rows, pii.fitted_once(spark))).collect()
    got = {r["doc_id"]: [x.split(":") for x in r["spans"].split(",") if x] for r in found}
    cut = {i: [(k, texts[i][int(a) : int(b)]) for k, a, b in x] for i, x in got.items()}
    assert all(r[f"n_{k}"] == 0 for r in found for k in pii.KINDS)  # none is a base span
    assert cut["phone"] == [("phone", "(212) 555-1234")] and cut["local"] == [("phone", "030 1234567")]
    assert cut["abroad"] == [("phone", "0049 30 1234567")] and cut["email"] == [("email", "jonas@grün-haus.de")]
    assert ("card", "4111.1111.1111.1111") in cut["card"]
    assert [cut[i] for i in ("version", "date", "order", "home")] == [[]] * 4


def test_overlapping_candidates_are_cut_to_the_value(spark):
    texts = {
        "stop": "ask jonas@grün-haus.de.", "brackets": "(jonas@grün-haus.de), she said", "quotes": 'mail "élodie@café-paris.fr"!',
        "date behind": "Tel. 030 1234567 2024-01-15", "date before": "on 2024-01-15 call (212) 555-1234 now",
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    found = pii.report(pii.find(rows, pii.fitted_once(spark))).collect()
    cut = {r["doc_id"]: [texts[r["doc_id"]][int(a) : int(b)] for _, a, b in (x.split(":") for x in r["spans"].split(",") if x)] for r in found}
    assert cut == {
        "stop": ["jonas@grün-haus.de"], "brackets": ["jonas@grün-haus.de"], "quotes": ["élodie@café-paris.fr"],
        "date behind": ["030 1234567"], "date before": ["(212) 555-1234"],
    }


def test_forests_are_stored_and_read_alike(spark):
    model = pii.fitted_once(spark)
    assert vars(pii.fitted_once(spark)) == vars(model) and set(model.trees) == {"email", "card", "phone"}


def test_calibrated_threshold():
    assert pii.calibrated([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.5, 0)], 0.75) == 0.6
    assert pii.calibrated([(0.9, 0), (0.2, 1)], 0.9) is None and pii.calibrated([], 0.9) is None


def test_secrets(docs, nothing, texts):
    findings, _ = secrets.scan(docs.union(docs))
    rows = secrets.report(findings).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        base = brute.secrets(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")
        ]
        assert r["base_sha256"] == brute.sha(",".join(base)) and set(base) <= set(r["spans"].split(","))
    assert secrets.scan(nothing)[0].collect() == []


def test_only_unseen_blobs_are_scanned(spark):
    old = spark.createDataFrame([(1, "token=abcdef1"), (2, "nothing")], "doc_id int, text string")
    _, ledger = secrets.scan(old)
    assert ledger.count() == 2 * len(secrets.RULES)
    marked = ledger.withColumn("found", F.filter("found", lambda s: F.lit(False)))  # a scan would find it again
    new = spark.createDataFrame([(5, "token=abcdef1"), (6, "secret: 12345678"), (None, "secret: 12345678")], "doc_id int, text string")
    findings, after = secrets.scan(new, marked)
    got = sorted((r["doc_id"] or 0, len(r["found"])) for r in findings.collect())
    assert got == [(0, 1), (5, 0), (6, 1)] and after.count() == 3 * len(secrets.RULES)


def test_only_unseen_pairs_of_blob_and_version_are_scanned(spark):
    old = spark.createDataFrame([(1, "token=abcdef1"), (2, "nothing")], "doc_id int, text string")
    _, ledger = secrets.scan(old, versions=(1,))
    assert sorted((r["version"], r["count"]) for r in ledger.groupBy("version").count().collect()) == [(1, 2)]
    new = old.union(spark.createDataFrame([(6, "eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.c2lnbmF0dXJlMTIz")], "doc_id int, text string"))
    findings, after = secrets.scan(new, ledger)
    fresh = after.join(ledger, ["blob", "version"], "left_anti").groupBy("version").count().collect()
    assert sorted((r["version"], r["count"]) for r in fresh) == [(1, 1), (2, 3), (3, 3)]
    assert sorted((r["doc_id"], [s["kind"] for s in r["found"]]) for r in findings.collect()) == [(1, ["assign"]), (2, []), (6, ["jwt"])]


def test_redaction(spark):
    rows = [(1, "é token=abcdef1 end", 3), (2, None, 4), (3, "clean", 5), (3, "clean", 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_chars bigint").selectExpr("*", "'x' AS blob", "1 AS found")
    clean = secrets.redact(docs, secrets.scan(docs)[1])
    assert clean.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "", r["n_chars"]) for r in clean.collect()) == [
        (1, "é [assign] end", 14), (2, "", 4), (3, "clean", 5), (3, "clean", 5),
    ]


BODY = [f"{c}IIEvQ+/{c * 56}" for c in "MNOP"] + ["QmFz"]


@pytest.mark.parametrize("label", ["PRIVATE KEY", "RSA PRIVATE KEY", "OPENSSH PRIVATE KEY", "PGP PRIVATE KEY BLOCK"])
def test_private_keys_are_redacted_whole(spark, label):
    begin, end = f"-----BEGIN {label}-----", f"-----END {label}-----"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n"
    long = "\n".join(BODY[:4] * 3000)
    shapes = {
        "lines": (f"a {begin}\n" + "\n".join(BODY) + f"\n{end} z", "z"),
        "crlf": (f"a {begin}\r\n" + "\r\n".join(BODY) + f"\r\n{end}\r\nz", "z"),
        "escaped": (f"a {begin}\\n" + "\\n".join(BODY) + f"\\n{end} z", "z"),
        "headers": (f"a {begin}\n{head}" + "\n".join(BODY) + f"\n{end} z", "z"),
        "long": (f"a {begin}\n{long}\n{end} z", "z"),
        "no end": (f"a {begin}\n" + "\n".join(BODY) + "\n\nplain words z", "plain words z"),
        "no end, headers": (f"a {begin}\n{head}" + "\n".join(BODY) + "\nplain words z", "plain words z"),
        "no end, long": (f"a {begin}\n{long}\nplain words z", "plain words z"),
        "no end, escaped": (f"a {begin}\\n" + "\\n".join(BODY), ""),
        "cut": (f"a {begin}\n" + "\n".join(BODY), ""),
        "indented": (f"a {begin}\n    " + "\n    ".join(BODY) + "\nplain words z", "plain words z"),
        "one line": (f"a {begin} " + " ".join(BODY[:4]) + " plain words z", "plain words z"),
        "end of another": (f"a {begin}\n" + "\n".join(BODY) + "\n-----END CERTIFICATE----- z", "z"),
        "bare": (f"a {begin} plain words z", "plain words z"),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in shapes.items()], "doc_id string, text string")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, secrets.scan(docs)[1]).collect()}
    for shape, (_, rest) in shapes.items():
        assert clean[shape].startswith("a [") and clean[shape].endswith(rest), shape
        assert not any(x in clean[shape] for x in [*BODY, "BEGIN", "IIEv", "DEK-Info"]), shape
        assert ("END" in clean[shape]) == (shape == "end of another"), shape


URLS = [
    None, "", "no scheme", "http://A.Example.COM/en/1?x#y", "https://www.example.com/en/", "http://x.net/es/?q", "http://net/fr/a",
    "http://notexample.com/en/", "ftp://h.net", "a://b://c/d", "http://user@h.com:80/x", "http://casino-win.example.org/en/1", "http://library.example.org/",
]


def test_bad_words_alone_are_blocked_and_unknown_names_stay(spark):
    """Hosts of one listed word, and hosts of words that no list and no rule of the table knows."""
    other = """python github mountainbike wikipedia nytimes kitchenware lighthouse umbrella quartz velvet falcon bridges planet
    hotel airport bakery dentist lawyer camera guitar printer fossil meadow harvest blossom galaxy engine river castle""".split()
    hosts = [f"http://{w}.net/" for w in urls.BAD] + [f"http://www.{w}.org/en/1" for w in urls.BAD] + [f"http://{w}.com/" for w in other]
    pages = spark.createDataFrame(list(enumerate(hosts)), "page_id int, url string")
    rows = {r["page_id"]: r["verdict"] for r in urls.judged(pages, urls.fit(urls.labelled_urls(spark)), rules=()).collect()}
    n = len(urls.BAD)
    for some in (range(n), range(n, 2 * n)):
        assert sum(rows[i] == "block" for i in some) >= 0.9 * n
    assert sum(rows[i] == "block" for i in range(2 * n, len(hosts))) <= 1
    null = spark.createDataFrame([(None, None), (None, "http://casino.net/")], "page_id int, url string")
    got = sorted((r["page_id"], r["host"], r["verdict"]) for r in urls.judged(null, urls.fit(urls.labelled_urls(spark))).collect())
    assert [g[0] for g in got] == [None, None] and {g[1] for g in got} == {"", "casino.net"}


def test_urls(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(3, URLS[3])], "page_id int, url string").withColumn("host", F.lit("x"))
    rows = urls.judged(pages, urls.fit(urls.labelled_urls(spark))).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        url = URLS[r["page_id"]] or ""
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
        host, path = (m[1].translate(brute.LOWER), m[2]) if m else ("", "")
        fits = [t for _, t in urls.RULES if ("." + host).endswith("." + t.split("/")[0]) and path.startswith(t[t.index("/") :])]
        rule = max(fits, key=len, default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule:
            assert r["verdict"] == {t: v for v, t in urls.RULES}[rule]
    verdicts = {r["page_id"]: r["verdict"] for r in rows}
    assert verdicts[11] == "block" and verdicts[12] == "allow" and verdicts[0] == "allow"
    assert urls.judged(pages.limit(0), urls.fit(urls.labelled_urls(spark))).collect() == []


def test_held_out_words(spark):
    """Urls of two words that never stand together in the table."""
    good = [f"http://{a}-{b}.example.org/en/7" for a, b in zip(urls.GOOD, urls.GOOD[11:])]
    bad = [f"http://{a}-{b}.example.org/en/7" for a, b in zip(urls.BAD, urls.BAD[11:])]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad)], "page_id int, url string")
    rows = urls.judged(pages, urls.fit(urls.labelled_urls(spark)), rules=()).collect()
    right = sum((r["verdict"] == "block") == (r["page_id"] >= len(good)) for r in rows)
    assert right >= 0.9 * len(rows)
