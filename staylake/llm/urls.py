"""URL filter: host and path rules, then a logistic regression (operator 9).

The regression works on hashed character n-grams of host and path and is fitted on a small labelled table
of urls. It decides where no rule does.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = 1 << 13
SIZES = (3, 4)
#: Of held-out names of neither list, this share at most may reach the threshold.
FALSE_ALARMS = 0.01

#: Rules of the query (fixed values): verdict, host and path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# The labelled table: hosts of one and of two words, made by rule from these lists and from names of neither.
BAD = """casino poker bets jackpot win lotto adult xxx porn cams pills viagra pharma cheap replica spam farm ads track
click popup loan payday crypto doubler free prize torrent warez keygen""".split()
GOOD = """news library school museum garden history science travel station nation relation health sport music theatre
weather recipe forum journal research city council kitchen orchard harbour mountain tension other thing winter""".split()
TOPS = ("example.com", "example.net", "example.org")
FRONTS = ("", "www.", "m.", "blog.")
PATHS = ("/en/12", "/de/345.html", "/fr/6789", "/es/1011/", "/en/2/", "/")
SYLLABLES = [a + b for a in "bcdfghjklmnprstvwz" for b in ("a", "e", "i", "o", "u", "an", "er", "in", "ol")]
OTHERS, HELD_OUT = 240, 240


def other_name(i: int) -> str:
    """A name of two to four syllables that hangs on its number alone; it is in no list."""
    return "".join(SYLLABLES[(i * 7919 + k * (i * 31 + 101) + k * k * 17) % len(SYLLABLES)] for k in range(2 + i % 3))


def _urls(hosts: list[str], label: int, step: int) -> list[tuple[str, float]]:
    return [
        (f"https://{FRONTS[(i * step) % 4]}{name}.{TOPS[(i + step) % len(TOPS)]}{PATHS[(i * step + i // 4) % len(PATHS)]}", float(label))
        for i, name in enumerate(hosts)
    ]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url``, ``label`` (1: block) and ``held_out``: every listed word as a host of its own and beside two others
    of its list, names of neither list as allowed, alone and beside an allowed word, and as many again that are
    held out of the fit."""
    rows = []
    for label, words in ((0, GOOD), (1, BAD)):
        n = len(words)
        for step in (1, 3):
            rows += _urls(words, label, step)
        rows += _urls([f"{w}-{words[(i + 1) % n]}" for i, w in enumerate(words)], label, 1)
        rows += _urls([f"{w}{words[(i + 5) % n]}" for i, w in enumerate(words)], label, 3)
    names = [other_name(i) for i in range(OTHERS)]
    rows += _urls([x if i % 2 else f"{x}-{GOOD[i % len(GOOD)]}" for i, x in enumerate(names)], 0, 1)
    held = _urls([other_name(i) for i in range(OTHERS, OTHERS + HELD_OUT)], 0, 3)
    marked = [(*r, False) for r in rows] + [(*r, True) for r in held]
    table = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label"), F.lit(h).alias("held_out")) for u, y, h in marked])
    return spark.range(1).select(F.explode(table).alias("r")).select("r.*")


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z as a-z; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host_of: Column, path_of: Column) -> Column:
    """Character n-grams, those of hosts and of paths kept apart."""

    def of(text: Column, mark: str, size: int) -> Column:
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        places = F.sequence(F.lit(1), F.greatest(F.length(framed) - size + 1, F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(size))))

    return F.concat(*[of(c, mark, size) for c, mark in ((host_of, "h"), (path_of, "p")) for size in SIZES])


def _hashed(urls: DataFrame) -> DataFrame:
    rows = urls.withColumn("tokens", tokens(F.col("host"), F.col("path")))
    return HashingTF(inputCol="tokens", outputCol="features", numFeatures=FEATURES, binary=True).transform(rows).drop("tokens")


def fit(labelled: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """The model, fitted on the rows of ``url`` and ``label`` that are not ``held_out``, and the chance from which it
    blocks: the lowest from one half that at most ``FALSE_ALARMS`` of the held-out allowed urls reach. A table
    small enough for one task."""
    columns = [host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "label"]
    rows = labelled.where("not held_out").select(*columns).coalesce(1)
    model = LogisticRegression(maxIter=60, regParam=0.01, probabilityCol="p").fit(_hashed(rows))
    held = model.transform(_hashed(labelled.where("held_out and label = 0").select(*columns)))
    edge = held.agg(F.percentile(vector_to_array("p")[1], 1 - FALSE_ALARMS)).first()[0]
    return model, max(0.5, edge or 0.0)


def ruled(host_of: Column, path_of: Column, rules) -> Column:
    """The longest rule that fits, as a struct of length, text and verdict; null if none does.

    A rule fits its host and all below it, if the path starts with the rule's path.
    """
    if not rules:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    table = F.array(
        *[
            F.struct(
                F.lit(len(text)).alias("length"),
                F.lit(text).alias("rule"),
                F.lit(verdict).alias("verdict"),
                F.lit(text.partition("/")[0]).alias("host"),
                F.lit("/" + text.partition("/")[2]).alias("path"),
            )
            for verdict, text in rules
        ]
    )

    def fits(r):
        below = F.concat(F.lit("."), host_of).endswith(F.concat(F.lit("."), r["host"]))
        return below & path_of.startswith(r["path"])

    return F.array_max(F.filter(table, fits))


def judged(urls: DataFrame, fitted: tuple[LogisticRegressionModel, float], rules=RULES, id_col="page_id", url_col="url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict`` and ``score``, the model's chance of a block.

    A null url, or one without ``://``, has an empty host and path and fits no rule. Repeated rows stay;
    other columns are left out.
    """
    model, threshold = fitted
    rows = urls.select(id_col, host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    rows = model.transform(_hashed(rows)).withColumn("r", ruled(F.col("host"), F.col("path"), rules))
    chance = vector_to_array("p")[1]
    own = F.when(chance > threshold, "block").otherwise("allow")
    return rows.select(
        id_col, "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"), chance.alias("score")
    )
