"""Secrets in texts: long tokens as candidates, a random forest against false positives.

Everything is a column expression or a Spark ML stage; no Python runs in the tasks.

Candidates are runs of at least ``LEAST`` key characters, and whatever a cue such as
``password =`` assigns.  Each is described by its length, how its character classes follow
each other, how much of it dictionary words cover, its path and its neighbouring words.  A
forest trained on labelled findings gives the probability that it is a secret.

Where no labels are at hand, ``weak_label`` labels the findings that rules can decide: what
a cue assigns and mixes letters with digits, or has a known vendor prefix, is a secret;
letters alone without a cue, and candidates that dictionary words mostly cover, are not.
The forest decides the rest.  Training takes a bounded number of findings of each label
(``per_label``); scoring covers every candidate of every whole text.

Defined results: null and empty texts have no findings; a null path is the path ``''``; a
repeated row is scanned each time; without findings of both labels nothing is removed and
the probability is 1 where only secrets were labelled, else 0; positions are code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmark.llm.labelled import sampled
from textmark.llm.frames import stored

LEAST = 20
PER_LABEL = 4000
TREES = 24
DEPTH = 6
KEPT = 0.5
CONTEXT = 80
HASHED = 64

#: Words that announce a secret, and words that fill tokens which are none.
CUES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "access_key", "auth", "bearer", "credential")
WORDS = (
    "example", "sample", "test", "dummy", "placeholder", "changeme", "your", "here", "insert", "password", "secret",
    "token", "key", "user", "name", "http", "https", "www", "file", "path", "class", "function", "return", "string",
    "value", "data", "null", "true", "false", "config", "version", "license", "public", "private", "index", "image",
    "content", "style", "container", "button", "header", "footer", "default", "the", "and", "ing", "tion", "ment",
    "that", "this", "with", "from", "for", "are", "was", "her", "ich", "sch", "ung", "der", "die", "und", "que",
    "les", "des", "eau", "ent", "los", "las", "ción", "ado", "ando",
)
#: Prefixes that vendors give their keys.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "xoxb-", "xoxp-", "sk_live_", "rk_live_", "glpat-", "AIza", "eyJ")

_KEY = "A-Za-z0-9_+/=-"
_CUE = "|".join(CUES)
_SIGN = "[\"']?[ ]{0,2}[=:][ ]{0,2}"
#: A cue may end a longer name (``DB_PASSWORD``, ``client_secret``) and be quoted, as in JSON.
_ASSIGNED = rf"(?i:(?<=(?:{_CUE}){_SIGN}[\"']?))[^\s\"'<>]{{8,}}+"
#: ``=``, ``_`` and ``-`` are key characters: a run stops where an assigned value starts.
_RUN = rf"(?<![{_KEY}])(?=[{_KEY}]{{{LEAST}}})(?:(?!{_ASSIGNED})[{_KEY}]){{{LEAST},}}+"
CANDIDATE = f"{_ASSIGNED}|{_RUN}"
_MIGHT = rf"[{_KEY}]{{{LEAST}}}|(?i:{_CUE}){_SIGN}"

NUMBERS = (
    "length", "digits", "upper", "lower", "other", "runs", "letter_digit", "digit_letter", "case_changes", "distinct",
    "hexadecimal", "repeated", "covered", "vendor", "cue", "assigned", "quoted", "test_path", "path_depth",
)


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: ``key, path, candidate, start, before, after``."""
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.col(text).alias("text")
    )
    # A cheap test first: most texts hold no candidate and need not be cut up.
    rows = rows.where(F.col("text").rlike(_MIGHT)).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select(
        "key", "path", "row",
        F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), F.lit(1)).alias("found"),
        F.split("text", CANDIDATE, -1).alias("between"),
    )
    place = F.posexplode("found").alias("place", "candidate")
    # A long name is a run itself: what precedes its value is the name, not only the sign.
    rows = rows.select("key", "path", "row", "between", "found", place)
    earlier = F.when(F.col("place") > 0, F.get("found", F.col("place") - 1)).otherwise("")
    rows = rows.select(
        "key", "path", "row", "place", "candidate",
        F.length(F.get("between", F.col("place"))).alias("gap"),
        F.substring(F.concat(earlier, F.get("between", F.col("place"))), -CONTEXT, CONTEXT).alias("before"),
        F.substring(F.get("between", F.col("place") + 1), 1, CONTEXT).alias("after"),
    )
    so_far = Window.partitionBy("row").orderBy("place")
    end = F.sum(F.col("gap") + F.length("candidate")).over(so_far)
    return rows.select(
        "key", "path", "candidate", (end - F.length("candidate")).cast("long").alias("start"), "before", "after"
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole.cast("double"), F.lit(1.0))


def described(rows: DataFrame) -> DataFrame:
    """Adds the numbers of ``NUMBERS`` and four words that are hashed to features."""
    c = F.col("candidate")
    size = F.length(c)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0"), "[^Aa0]", "-")
    low = F.lower(c)
    covered = size - F.length(F.regexp_replace(low, "|".join(sorted(WORDS, key=len, reverse=True)), ""))
    last = F.regexp_extract(F.lower("before"), r"([\w-]+)\W*$", 1)
    second = F.regexp_extract(F.lower("before"), r"([\w-]+)\W+[\w-]+\W*$", 1)
    following = F.regexp_extract(F.lower("after"), r"^\W*([\w-]+)", 1)
    numbers = {
        "length": F.least(size, F.lit(256)).cast("double"),
        "digits": _share(_count(c, "[0-9]"), size),
        "upper": _share(_count(c, "[A-Z]"), size),
        "lower": _share(_count(c, "[a-z]"), size),
        "other": _share(_count(c, "[^A-Za-z0-9]"), size),
        "runs": _share(F.length(F.regexp_replace(classes, r"(.)\1+", "$1")).cast("double"), size),
        "letter_digit": _share(_count(classes, "[Aa](?=0)"), size),
        "digit_letter": _share(_count(classes, "0(?=[Aa])"), size),
        "case_changes": _share(_count(classes, "a(?=A)|A(?=a)"), size),
        "distinct": F.size(F.array_distinct(F.split(F.substring(c, 1, 256), ""))).cast("double"),
        "hexadecimal": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "repeated": _share(_count(c, r"(.)(?=\1)"), size),
        "covered": _share(covered.cast("double"), size),
        "vendor": c.rlike("^(" + "|".join(PREFIXES) + ")").cast("double"),
        "cue": last.rlike(f"^.*({_CUE})$").cast("double"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": F.col("before").rlike("[\"'`]$").cast("double"),
        "test_path": F.lower("path").rlike("test|example|sample|mock|fixture|demo").cast("double"),
        "path_depth": _count(F.col("path"), "/"),
    }
    words = {
        "last_word": last, "second_word": second, "next_word": following,
        "path_top": F.element_at(F.split("path", r"[/\\]"), 1),
    }
    return rows.withColumns(numbers | words)


def weak_label() -> Column:
    """1 a secret, 0 none, null undecided, over ``described`` findings."""
    mixed = (F.col("digits") > 0.1) & (F.col("upper") + F.col("lower") > 0.1)
    secret = (F.col("vendor") > 0) & (F.col("digits") > 0) | (F.col("cue") > 0) & (F.col("assigned") > 0) & mixed
    none = (F.col("cue") == 0) & ((F.col("digits") == 0) | (F.col("covered") > 0.8))
    return F.when(secret, 1).when(none, 0)


def _features(rows: DataFrame) -> DataFrame:
    hashed = FeatureHasher(inputCols=["last_word", "second_word", "next_word", "path_top"], outputCol="words", numFeatures=HASHED)
    return VectorAssembler(inputCols=[*NUMBERS, "words"], outputCol="features").transform(hashed.transform(rows))


@dataclass
class Forest:
    model: RandomForestClassificationModel | None
    constant: float = 0.0

    def probability(self, rows: DataFrame) -> DataFrame:
        """Adds ``probability`` to described findings."""
        if self.model is None:
            return rows.withColumn("probability", F.lit(self.constant))
        rows = self.model.transform(_features(rows))
        return rows.withColumn("probability", vector_to_array("probability")[1]).drop("features", "words", "rawPrediction", "prediction")


def train(labelled: DataFrame, per_label: int = PER_LABEL, trees: int = TREES, depth: int = DEPTH, seed: int = 3) -> Forest:
    """A forest from described findings with ``label`` 0 or 1; null labels are left out.

    Findings are drawn by the hash of what describes them, so the same findings give the
    same sample, and copies of one finding count once.
    """
    words = ["last_word", "second_word", "next_word", "path_top"]
    rows = labelled.where(F.col("label").isin(0, 1)).select("candidate", "label", *NUMBERS, *words)
    rows = rows.withColumn("key", F.xxhash64("candidate", *words)).drop("candidate")
    chosen = sampled(rows.select("key", "label"), "key", "label", per_label)
    rows = rows.join(F.broadcast(chosen), ["key", "label"]).dropDuplicates(["key", "label"])
    rows = stored(rows.coalesce(1), "secrets-training")
    seen = {x["label"]: x["count"] for x in rows.groupBy("label").count().collect()}
    if len(seen) < 2:
        return Forest(None, 1.0 if 1 in seen else 0.0)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features")
    return Forest(forest.fit(_features(rows.orderBy("key")).select("label", "features")))


def scored(found: DataFrame, forest: Forest, key: str = "doc_id") -> DataFrame:
    """Described findings as ``key, start, candidate, probability, is_secret``."""
    return forest.probability(found).select(
        F.col("key").alias(key), "start", "candidate", "probability", (F.col("probability") >= KEPT).alias("is_secret")
    )


def scan(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Every finding of ``docs`` with its probability, as ``scored``."""
    return scored(described(findings(docs, key, text, path)), forest, key)
