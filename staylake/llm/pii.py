"""Personal data: generated candidates scored by boosted trees (operator 3).

Base spans follow fixed patterns and checks. High-recall generators propose further, overlapping spans of the
same kinds. A small gradient-boosted forest judges format and context of a candidate. It is fitted on a small
labelled table (``labelled_spans``) that holds forms the base patterns do not know, so it can find what they
miss. A generator's span is proposed whole and cut: without marks around it, and for numbers each run of its groups;
of chosen candidates that overlap the one with the best score stays. Each kind has its own threshold, the lowest
score at which candidates reach the wanted precision, each form judged by a forest that was fitted without it; the
forest is then fitted on all.
``fit`` labels candidates of a sample of documents by the base spans instead and learns no more than those.
The forest becomes a column expression, so candidates are scored in their document's row.
"""

from __future__ import annotations

import hashlib
import json
import os
import random
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm.spans import SPAN, ordered, spans, written
from staylake.session import scratch_dir

LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Groups and runs are possessive where nothing behind them could use what they give back, so that long
#: texts are walked in a loop. A local part begins where its run does, or where the last match ended.
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

KINDS = ("email", "ip", "card", "phone")

#: Generators: more than the base patterns accept.
WIDE = {
    "email": r"[^\x20\x09-\x0D@]{1,64}@[^\x20\x09-\x0D@]{1,255}",
    "ip": r"[0-9]++(?:\.[0-9]++){2,}+",
    "card": r"[0-9](?:[\x20./-]?[0-9]){9,}+",
    "phone": r"[+(]?[0-9][()./0-9-]*+(?:\x20[()./+0-9-]++){0,7}+",
}
#: Digits that a candidate number of a kind has; a run has at most eight groups, of which candidates skip some and
#: take some.
DIGITS = {"phone": (7, 15), "card": (12, 19)}
SKIPPED, TAKEN = range(4), range(1, 6)
OPENING, CLOSING = r"^[\p{Ps}\p{Pi}\"'<,;:.!?*_]+", r"[\p{Pe}\p{Pf}\"'>,;:.!?*]+$"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of a match pass Luhn's check."""
    digits = F.reverse(_digits(match))
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i) - F.when(value(i) > 9, 9).otherwise(0)
    )
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    digit = F.regexp_like(text, F.lit("[0-9]"))
    size = lambda s: F.length(_digits(s["match"]))
    return {
        "email": spans(text, EMAIL, text.contains("@")),
        "ip": F.filter(spans(text, IP, digit), lambda s: F.regexp_like(s["match"], F.lit(rf"^{PART}(?:\.{PART}){{3}}$"))),
        "card": F.filter(spans(text, CARD, digit), lambda s: size(s).between(12, 19) & luhn(s["match"])),
        "phone": F.filter(spans(text, PHONE, digit & text.contains("+")), lambda s: size(s).between(9, 15)),
    }


CUES = {
    "email": "(?i)mail|contact|write|kontakt|courriel|correo",
    "ip": "(?i)\\bip\\b|host|server|address|adresse|from",
    "card": "(?i)card|visa|karte|carte|tarjeta|pay",
    "phone": "(?i)phone|tel|call|fax|mobil|anruf",
}

def _size_of(chars: str):
    return lambda m, before, after, cue: F.length(F.regexp_replace(m, f"[^{chars}]", ""))


def _flag(test):
    return lambda m, before, after, cue: test(m, before, after, cue).cast("int")


#: Feature -> function of a candidate's text, the 20 characters before and after it, and its kind's cues.
FEATURES = {
    "length": lambda m, before, after, cue: F.length(m),
    "digits": _size_of("0-9"),
    "letters": _size_of("A-Za-z"),
    "dots": _size_of("."),
    "blanks": _size_of(" "),
    "dashes": _size_of("-"),
    "brackets": _size_of("()"),
    "slashes": _size_of("/"),
    "others": lambda m, before, after, cue: F.length(F.regexp_replace(m, "[A-Za-z0-9.()/@+ _%-]", "")),
    "dots_behind_at": lambda m, before, after, cue: F.length(F.regexp_replace(F.regexp_replace(m, "^.*@", ""), "[^.]", "")),
    "groups": lambda m, before, after, cue: F.size(F.split(m, "[^0-9]+")),
    "longest_digits": lambda m, before, after, cue: F.array_max(F.transform(F.split(m, "[^0-9]+"), lambda x: F.length(x))),
    "plus": _flag(lambda m, before, after, cue: F.startswith(m, F.lit("+"))),
    "blank_before": _flag(lambda m, before, after, cue: F.regexp_like(before, F.lit("(^|[ \\t\\n])$"))),
    "blank_after": _flag(lambda m, before, after, cue: F.regexp_like(after, F.lit("^([ \\t\\n.,;]|$)"))),
    "digit_before": _flag(lambda m, before, after, cue: F.regexp_like(before, F.lit("[0-9.-]$"))),
    "digit_after": _flag(lambda m, before, after, cue: F.regexp_like(after, F.lit("^[0-9.-]"))),
    "first_digits": lambda m, before, after, cue: F.length(F.regexp_extract(m, "[0-9]+", 0)),
    "last_digits": lambda m, before, after, cue: F.length(F.regexp_extract(m, "([0-9]+)[^0-9]*$", 1)),
    "zero": _flag(lambda m, before, after, cue: F.regexp_like(m, F.lit("^[(+]?0"))),
    "mark_before": _flag(lambda m, before, after, cue: F.regexp_like(m, F.lit(OPENING))),
    "mark_after": _flag(lambda m, before, after, cue: F.regexp_like(m, F.lit(CLOSING))),
    "group_before": _flag(lambda m, before, after, cue: F.regexp_like(before, F.lit(r"[0-9)]\x20$"))),
    "group_after": _flag(lambda m, before, after, cue: F.regexp_like(after, F.lit(r"^\x20[(]?[0-9]"))),
    "bracket": _flag(lambda m, before, after, cue: F.startswith(m, F.lit("("))),
    "year": _flag(lambda m, before, after, cue: F.regexp_like(m, F.lit("(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"))),
    "top_letters": lambda m, before, after, cue: F.length(F.regexp_extract(m, r"@.*\.(\p{L}{2,})[.,;:!?)>\]\"']*$", 1)),
    "luhn": _flag(lambda m, before, after, cue: F.when(F.length(_digits(m)).between(12, 19), luhn(m)).otherwise(False)),
    "cue": _flag(lambda m, before, after, cue: F.regexp_like(before, F.lit(cue))),
}

#: Parts of the labelled table that judge one another; share of true ones among the candidates that are added.
FOLDS, PRECISION = 4, 0.8

Tree = tuple | float


@dataclass
class Model:
    """Per kind: trees as (feature, cut, left, right) or leaf values, their weights, and a threshold."""

    trees: dict[str, list[Tree]] = field(default_factory=dict)
    weights: dict[str, list[float]] = field(default_factory=dict)
    threshold: dict[str, float] = field(default_factory=dict)

    def score(self, kind: str, features: Column) -> Column:
        """Probability of a candidate, from its features as a struct."""
        names = list(FEATURES)

        def value(node: Tree) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, cut, left, right = node
            return F.when(features[names[feature]] <= cut, value(left)).otherwise(value(right))

        margin = reduce(lambda a, b: a + b, [value(t) * w for t, w in zip(self.trees[kind], self.weights[kind])])
        return 1 / (1 + F.exp(-2 * margin))


def _cut(s: Column, skip: Column, match: Column) -> Column:
    start = s["start"] + F.length(skip)
    return F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match"))


def proposed(kind: str, found: Column) -> Column:
    """Generated spans and what is cut from them, without repeats: an address without the marks around it, every run
    of groups of a number."""

    def cuts(s):
        m = s["match"]
        if kind == "email":
            lead = F.regexp_extract(m, OPENING, 0)
            bare = F.regexp_replace(F.substring(m, F.length(lead) + 1, F.length(m)), CLOSING, "")
            return F.array(s, _cut(s, lead, bare))
        if kind not in DIGITS:
            return F.array(s)
        runs = [
            _cut(s, F.regexp_extract(m, rf"^(?:\S+\x20){{{j}}}", 0), F.regexp_extract(m, rf"^(?:\S+\x20){{{j}}}(\S+(?:\x20\S+){{{k - 1}}})", 1))
            for j in SKIPPED
            for k in TAKEN
        ]
        bare = [_cut(x, F.lit(""), F.regexp_replace(x["match"], r"[().,/+-]+$", "")) for x in (s,)]
        return F.concat(F.array(s, *bare), F.when(m.contains(" "), F.array(*runs)).otherwise(F.array().cast(f"array<{SPAN}>")))

    def sized(c):
        if kind not in DIGITS:
            return F.length(c["match"]) > 0
        return F.regexp_like(c["match"], F.lit("[0-9]$")) & F.length(_digits(c["match"])).between(*DIGITS[kind])

    return F.filter(F.array_distinct(F.flatten(F.transform(found, cuts))), sized)


def candidates(kind: str, text: Column, base: Column) -> Column:
    """Proposed spans of a kind with their features and whether they are base spans."""

    def described(s):
        start, end = s["start"], s["end"]
        before = F.substring(text, F.greatest(start - 19, F.lit(1)).cast("int"), F.least(start, F.lit(20)).cast("int"))
        after = F.substring(text, (end + 1).cast("int"), F.lit(20))
        values = [f(s["match"], before, after, CUES[kind]).cast("double").alias(n) for n, f in FEATURES.items()]
        same = F.exists(base, lambda b: (b["start"] == start) & (b["end"] == end))
        return F.struct(start.alias("start"), end.alias("end"), F.struct(*values).alias("features"), same.alias("same"))

    gate = text.contains("@") if kind == "email" else F.regexp_like(text, F.lit("[0-9]"))
    return F.transform(proposed(kind, spans(text, WIDE[kind], gate)), described)


def _tree(node) -> Tree:
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def sampled(docs: DataFrame, documents: int, id_col: str) -> DataFrame:
    """``documents`` documents whose ids hash lowest; only ids are read to choose them."""
    ids = docs.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(documents)
    return docs.join(F.broadcast(ids), id_col, "left_semi")


def fit(
    docs: DataFrame, documents: int = 4000, precision: float = 0.98, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Forests on the candidates of at most ``documents`` documents, labelled by the base spans.

    Documents are dealt to four parts, and a forest fitted on three judges the fourth. A kind without 10 candidates of either label has
    no forest: it keeps its base spans only.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = sampled(docs, documents, id_col).select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    each = [
        rows.select("id", F.lit(k).alias("kind"), F.explode(candidates(k, F.col("text"), F.col(k))).alias("c")) for k in KINDS
    ]
    fold = F.pmod(F.xxhash64("id"), F.lit(FOLDS)).alias("fold")
    place = F.struct("id", "c.start", "c.end").alias("place")
    table = reduce(DataFrame.unionAll, each).select("kind", fold, place, "c.features.*", F.col("c.same").cast("int").alias("label"))
    return _fitted(table.withColumn("judged", F.lit(True)), precision)


def _fitted(table: DataFrame, precision: float) -> Model:
    """``table``: ``kind``, features, ``label``, the ``fold`` that judges a row, ``judged``, whether a threshold counts
    it, and the ``place`` of which only the candidate of the best score counts, as it is the one chosen."""
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(table)
    table = table.select("kind", "label", "judged", "fold", "place", "vector").coalesce(1).cache()  # bounded by the sample
    counts = {(r["kind"], r["label"]): (r["n"], r["free"]) for r in table.groupBy("kind", "label").agg(F.count("*").alias("n"), F.sum(F.col("judged").cast("int")).alias("free")).collect()}
    model = Model()
    for kind in KINDS:
        true, false = counts.get((kind, 1), (0, 0)), counts.get((kind, 0), (0, 0))
        if min(true[0], false[0]) < 10 or not true[1]:
            continue
        rows = table.where(F.col("kind") == kind)
        grower = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=10, maxDepth=4, stepSize=0.3, seed=7, cacheNodeIds=False)
        scored = []
        for fold in range(FOLDS):
            held = rows.where((F.col("fold") == fold) & F.col("judged"))
            others = rows.where(F.col("fold") != fold)
            if others.select("label").distinct().count() < 2:
                continue
            held = grower.fit(others).transform(held).select("place", "label", vector_to_array("probability")[1].alias("p"))
            best = held.groupBy("place").agg(F.max(F.struct("p", -F.col("label"))).alias("best"))
            scored += [(r["best"][0], -r["best"][1]) for r in best.collect()]
        cut = calibrated(scored, precision)
        if cut is not None:
            fitted = grower.fit(rows)
            model.trees[kind] = [_tree(t._call_java("rootNode")) for t in fitted.trees]
            model.weights[kind] = list(fitted.treeWeights)
            # The expression sums in another order than the library.
            model.threshold[kind] = max(0.5, float(cut)) - 1e-9
    table.unpersist()
    return model


# The labelled table, made by rule: "#" is a digit, "%" a digit from 2 to 9, "@" in forms of names stays.
NAMES = "anna.weber jörg max_b info kontakt j.dupont marie+news élodie sales 李雷 o'neil x.y team7".split()
SITES = "müller-büro.de café-paris.fr пример.рф españa.es bücher.example münchen.bayern 例子.公司 räder.co.at website.org mail.example.com".split()
TRUE = {
    "ip": ["10.%#.0.%", "192.168.%#.1#", "172.16.%.%#", "8.8.%.%", "1##.%#.1##.%"],
    "phone": [
        "+49 30 %######", "+1 (%##) %##-####", "+33 % ## ## ## ##", "+44 20 %### ####", "(%##) %##-####", "(0%#) %######", "(0%##) %## ## ##",
        "0%# %######", "0%## %#######", "0%##/%######", "0%#-%#######", "00%# %# %######", "00%# %## %## ####", "00%%%########",
        "%##-%##-####", "0% ## ## ## ##", "0%## %## ####", "020 %### ####", "0%##-%## ## ##",
    ],
    "card": ["4###.####.####.###", "5%##.####.####.###", "4###/####/####/###", "3%##.######.####", "4### #### #### ###", "5###-####-####-###", "4##############"],
}
FALSE = {
    "email": [
        "root@localhost", "@home", "user@", "git@v%", "x@y", "pkg@^%.#.#", "price@%#", "%#@%#€", "u@h", "name@host:~/src", "call@%:00",
        "image@2x", "a@@b", "user@[host]", "mod@latest", "f(x)@g(y)", "at@...", "(@)", "col@row=%", "$x@$y", "me@work,", "10kg@$%#", "rev@{%}", "sha@main",
    ],
    "ip": ["%.#.%#", "%#.%.20%#", "%.#.#.#.%", "3%#.%##.4##.1", "%#.##.##.##.%#", "1.%##.###", "%.%.%", "2.%#.%.0#.#", "9##.%#.##.%"],
    "phone": [
        "20%#-01-%#", "%#.0%.20%#", "1%/2#/20%#", "0%/1#/199#", "199#-20%#", "20%#/%#", "0%.1#.20%#", "01.0%.199#", "%.#.%#.#", "%#.%#.%#.%##", "1.%##.###", "%.%##.###.###",
        "20%########", "%########", "%#######", "1%##########", "%### %### ###", "%# %# %# %# %#", "%## %## %##", "97%-3-1%-%#####-%", "%###-20%#-0%##", "192.168.%#.1#",
        "%#.%### 1#.%###", "0.%######", "0.%#### 0.%####", "00%####", "0%######", "4### #### #### ####", "20%#0%1#%#####", "%##.%##.%##", "%#-%#-%#-%#", "1%/%# 1%/%#", "%###.%###.%###",
    ],
    "card": [
        "20%#############", "%#########", "20%#.0%.1#.%#.%#", "97%-3-1%-######-%", "97%.3.1%.######.%", "0%## %## ####", "%.%##.###.###", "4### #### #### ####",
        "4###.####.####.####", "5###-####-####-####", "20%#-0%-1# 1%", "20%#-01-%#-20%#-02-%#", "%###############", "%### %### %### %### %###", "0%# %########", "%#/%#/20%#/%#/%#",
    ],
}
#: Dotted quads and times that pass Luhn's check by chance are no cards.
LUCKY = ["1##.1##.%#.1#", "1##.1##.1##.1#", "2%#.1##.1##.2%", "20%#.0%.1#.%#.%", "%#/%#/20%#/%#/%", "20%#-01-%#-1#-%#"]
TOLD = {
    "email": ["Write to {} today", "e-mail: {}", "Kontakt {} (Büro)", "mail {}"],
    "ip": ["host {} answered", "the server at {} is down", "IP {}", "from {} to"],
    "card": ["card {} was used", "Karte: {}", "pay with {} now", "Visa {}"],
    "phone": ["call {} now", "Phone: {}", "Tel. {}", "fax {} or", "mobil {}", "phone number {} please"],
}
UNTOLD = ["{}", "we found {} there", "Name, {}", "see {} below", "the entry {} is new", "or {} and", "x: {}"]
#: Marks and other numbers that are not part of the value.
AROUND = ["({}),", "<{}>.", '"{}"', "{}.", "{}; 2024-01-15", "on 2024-01-15 {} or", "{} 2023-11-02", "page 12 {} left"]
OTHERWISE = ["order {} shipped", "version {} is out", "on {} we met", "invoice no. {}", "since {}", "ISBN {}", "page {}", "build {} failed"]


def _written(rng: random.Random, form: str) -> str:
    return "".join(str(rng.randrange(10)) if c == "#" else str(rng.randrange(2, 10)) if c == "%" else c for c in form)


def _checked(form: str, valid: bool, rng: random.Random) -> str:
    """A number of the form and a last digit that passes Luhn's check, or one that does not."""

    def total(text):
        digits = [int(c) * (1 + k % 2) for k, c in enumerate(reversed([c for c in text if c.isdigit()]))]
        return sum(d - 9 if d > 9 else d for d in digits) % 10

    text = _written(rng, form)
    good = next(d for d in range(10) if total(f"{text}{d}") == 0)
    return f"{text}{good if valid else (good + rng.randrange(1, 10)) % 10}"


def labelled_rows(copies: int = 6) -> list[tuple]:
    """``id``, ``kind``, ``form``, ``text``, ``start``, ``end`` and ``label``: one marked value a text, some 2,400 texts.

    Positives have every form of their generator, with base forms among them, half behind their kind's cues and
    half without; negatives are other numbers and names in the same places and in their own. Numbers are drawn
    from a fixed seed. Dotted quads have no form beyond the base pattern.
    """
    rng, rows = random.Random(5), []

    def add(kind, form, value, label, places):
        place = rng.choice(places)
        start = place.index("{}")
        rows.append((len(rows), kind, form, place.replace("{}", value), start, start + len(value), label))

    for kind in KINDS:
        forms = [f"{n}@{s}" for n in NAMES for s in SITES] if kind == "email" else TRUE[kind]
        for k in range(copies * (1 if kind == "email" else 4)):
            for form in forms if kind != "email" else forms[k :: copies]:
                value = form if kind == "email" else _checked(form, True, rng) if kind == "card" else _written(rng, form)
                add(kind, form.partition("@")[2] or form, value, 1, (TOLD[kind] if (k + len(rows)) % 2 else UNTOLD) + AROUND)
        for _ in range(copies * 3):
            for form in FALSE[kind]:
                # A card's last digit is drawn anew, so that it fails the check.
                value = _checked(form[:-1], False, rng) if kind == "card" else form if kind == "email" and "%" not in form else _written(rng, form)
                add(kind, form, value, 0, rng.choice([TOLD[kind], UNTOLD, OTHERWISE, OTHERWISE]))
    for _ in range(copies * 3):
        for form in LUCKY:
            add("card", form, _checked(form, True, rng), 0, rng.choice([TOLD["card"], UNTOLD, TOLD["ip"]]))
    return rows


def labelled_spans(spark: SparkSession, copies: int = 6) -> DataFrame:
    """The rows of :func:`labelled_rows` as a table."""
    columns = "id long, kind string, form string, text string, start long, end long, label int"
    return spark.createDataFrame(labelled_rows(copies), columns).coalesce(1)


def fitted_once(spark: SparkSession, precision: float = PRECISION) -> Model:
    """The forests of the labelled table, fitted once and stored below the shared folder under the hash of what they
    depend on."""
    inputs = labelled_rows(), list(FEATURES), WIDE, DIGITS, OPENING, CLOSING, CUES, FOLDS, precision
    path = f"{os.path.dirname(scratch_dir(spark, 'forests'))}/pii-forests-{hashlib.sha256(repr(inputs).encode()).hexdigest()}"
    try:
        stored_model = json.loads(spark.read.text(path).first()[0])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        model = fit_labelled(labelled_spans(spark), precision)
        spark.createDataFrame([(json.dumps(vars(model)),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return model
    node = lambda x: (x[0], x[1], node(x[2]), node(x[3])) if isinstance(x, list) else x
    trees = {kind: [node(t) for t in trees] for kind, trees in stored_model["trees"].items()}
    return Model(trees, stored_model["weights"], stored_model["threshold"])


def fit_labelled(labelled: DataFrame, precision: float = PRECISION) -> Model:
    """Forests on the candidates of a table as ``labelled_spans`` makes it; those that are a marked positive are true.

    Forms are dealt to four parts, and a forest fitted on three judges the fourth. The threshold counts only
    candidates that overlap no base span: those are what it decides on. A kind without such a true one keeps its base spans only.
    """
    marked = labelled.select("id", "kind", "form", "text", F.col("start").alias("s"), F.col("end").alias("e"), F.col("label").alias("y"))
    marked = marked.select("*", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    fold = F.pmod(F.xxhash64("kind", "form"), F.lit(FOLDS)).alias("fold")

    def of(kind):
        rows = marked.where(F.col("kind") == kind).select("id", "kind", fold, "s", "e", "y", F.col(kind).alias("b"), F.explode(candidates(kind, F.col("text"), F.col(kind))).alias("c"))
        marked_one = (F.col("s") == F.col("c.start")) & (F.col("c.end") == F.col("e"))
        free = ~F.exists("b", lambda b: (b["start"] < F.col("c.end")) & (F.col("c.start") < b["end"]))
        return rows.select("kind", "fold", F.col("id").alias("place"), "c.features.*", F.when(marked_one, F.col("y")).otherwise(0).alias("label"), free.alias("judged"))

    return _fitted(reduce(DataFrame.unionAll, [of(k) for k in KINDS]), precision)


def calibrated(scored: list[tuple[float, int]], precision: float) -> float | None:
    """The lowest score at and above which the share of true candidates is at least ``precision``."""
    best, true = None, 0
    ranked = sorted(scored, reverse=True)
    for n, (score, label) in enumerate(ranked, 1):
        true += label
        last = n == len(ranked) or ranked[n][0] < score
        if last and true >= precision * n:
            best = score
    return best


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base spans of each kind, and ``found``: base and chosen spans in order.

    A candidate is chosen if its score reaches its kind's threshold and it overlaps no base span of the kind and
    no candidate of a better score that was chosen; of equal scores the first, then the longest. A null text is an
    empty one; other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("t"))
    rows = rows.select(id_col, "t", *[c.alias(f"b_{k}") for k, c in base_spans(F.col("t")).items()])
    wide = [candidates(k, F.col("t"), F.col(f"b_{k}")).alias(f"c_{k}") for k in model.trees]
    rows = rows.select(id_col, *[f"b_{k}" for k in KINDS], *wide)

    def good(kind: str) -> Column:
        """Candidates free of base spans that reach the threshold, best first."""
        base = F.col(f"b_{kind}")

        def scored(c):
            return F.struct((-model.score(kind, c["features"])).alias("score"), c["start"].alias("start"), (-c["end"]).alias("end"))

        free = F.filter(F.col(f"c_{kind}"), lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        return F.sort_array(F.filter(F.transform(free, scored), lambda c: c["score"] <= -model.threshold[kind]))

    rows = rows.select("*", *[good(k).alias(f"g_{k}") for k in model.trees])

    def chosen(kind: str) -> Column:
        if kind not in model.trees:
            return F.col(f"b_{kind}")
        none = F.array().cast(f"array<{SPAN}>")

        def keep(kept, c):
            span = F.struct(c["start"].alias("start"), (-c["end"]).alias("end"), F.lit("").alias("match"))
            meets = F.exists(kept, lambda k: (k["start"] < span["end"]) & (span["start"] < k["end"]))
            return F.when(meets, kept).otherwise(F.concat(kept, F.array(span)))

        return F.concat(F.col(f"b_{kind}"), F.aggregate(f"g_{kind}", none, keep))

    return rows.select(
        id_col,
        *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        ordered({k: F.col(f"b_{k}") for k in KINDS}).alias("base"),
        ordered({k: chosen(k) for k in KINDS}).alias("found"),
    )


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans written out."""
    counts = [f"n_{k}" for k in KINDS]
    digest = F.sha2(written(F.col("base")), 256).alias("base_sha256")
    return found.select(id_col, *counts, digest, written(F.col("found")).alias("spans"))
