"""Secret scanning with a random forest against false positives, in DataFrame
functions and Spark ML only.

High-recall candidates are runs of token characters with a digit, quoted values
after an assignment, and values of six or more characters, quoted or not, assigned to
the name of a credential. A forest trained on labelled findings rates each by
its length, character classes and transitions, dictionary coverage, path and
neighbouring words. Transition frequencies and the dictionary come from the
word counts of the whole corpus.

``scan`` takes labelled findings where they exist. Where there are none,
``distant_labels`` labels the corpus's own candidates by their context (an
assignment to a credential name or not; a value of dictionary words alone is no
secret) and hides the context from the forest
in half of the rows, so that it must also learn from the strings themselves.
The forest is fitted on at most ``max_labelled`` findings.

Defined cases: null and empty texts have no candidates; a null path is empty;
repeated rows give a finding each; texts are searched whole, in time linear in
their length; when the labels hold one class only, every candidate gets that
class; an empty table gives no findings. Columns other than id, text and path
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import staged

#: Characters of tokens; ``=`` only pads their end, so a name and its value are two.
TOKEN = "A-Za-z0-9+/_"
NAME = "(?:token|secret|passw|pwd|api.?key|key|auth|credential)"
#: Just after an assignment to a credential name. Java looks back over a bounded
#: length only; the first test is short and fails nearly everywhere.
ASSIGNED = rf"(?<=[=:]\s?[\"']?)(?<=(?i:{NAME})\w{{0,16}}[\"']?\s?[=:]\s?[\"']?)"
CANDIDATE = (
    rf"(?<![{TOKEN}-])(?=[A-Za-z+/_-]*[0-9])[{TOKEN}-]{{16,}}={{0,2}}"
    r"|(?<=[=:]\s?[\"'])[^\s\"']{8,}"
    rf"|{ASSIGNED}[^\s\"',;&]{{6,}}"
)
CONTEXT_CHARS = 40
CREDENTIAL = rf"(?i){NAME}\w*[\"']?\s*[=:]\s*[\"']?$"
#: Share of dictionary words from which an assigned value is prose or a placeholder.
PROSE_COVERAGE = 0.8
ASSIGNMENT = r"[=:]\s*[\"']?$"
TEST_PATH = r"(?i)(?:^|[/_.-])(?:tests?|examples?|samples?|fixtures?|docs?|mocks?)(?:$|[/_.-])"
#: Words in fewer documents' texts than this are no dictionary words.
DICTIONARY_COUNT = 5
FRAGMENT = "[a-z]{4,}"

FEATURES = (
    "length", "digit_share", "upper_share", "symbol_share", "class_changes", "distinct_share", "hex_only",
    "transition", "coverage", "slashes", "path_depth", "test_path", "credential_before", "assigned", "quoted",
    "word_before", "word_after",
)
CONTEXT = ("credential_before", "assigned", "quoted", "word_before", "word_after")


def candidates(docs: DataFrame, path_col: str | None = None) -> DataFrame:
    """doc_id, path, start, end (code points), candidate, before, after."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    # numbered before the texts are taken apart: one number for each text
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        path.alias("path"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    # the texts between candidates give positions and contexts
    between = F.when(F.col("text").rlike(CANDIDATE), F.split("text", CANDIDATE, -1))
    pieces = rows.select(
        "doc_id",
        "path",
        "row",
        F.posexplode(
            F.arrays_zip(between.alias("b"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("c"))
        ).alias("i", "p"),
    )
    # one text's candidates are numbered together: lengths and contexts move, not the text
    pieces = pieces.select(
        "doc_id",
        "path",
        "row",
        "i",
        F.col("p.c").alias("candidate"),
        F.length("p.b").alias("gap"),
        F.substring("p.b", -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
        F.substring("p.b", 1, CONTEXT_CHARS).alias("first"),
    )
    order = W.partitionBy("row").orderBy("i")
    size = F.col("gap") + F.coalesce(F.length("candidate"), F.lit(0))
    placed = pieces.withColumn("end", F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0))).withColumn(
        "after", F.lead("first").over(order)
    )
    return placed.where("candidate is not null").select(
        "doc_id",
        "path",
        (F.col("end") - F.length("candidate")).alias("start"),
        "end",
        "candidate",
        "before",
        "after",
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all texts; words are runs of letters, lower-cased."""
    words = F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), r"[^\p{L}]+")
    return docs.select(F.explode(words).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _code(char: Column) -> Column:
    """a..z as 0..25, every other character as 26."""
    code = F.ascii(char) - 97
    return F.when(code.between(0, 25), code).otherwise(F.lit(26))


def transitions(words: DataFrame) -> list[float]:
    """Log-probability of each of the 27 x 27 character steps, row by row."""
    step = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))
    steps = words.where(F.length("word") > 1).select("n", step.alias("s"))
    cell = _code(F.substring("s", 1, 1)) * 27 + _code(F.substring("s", 2, 1))
    rows = steps.groupBy(cell.cast("int").alias("cell")).agg(F.sum("n").alias("n")).collect()  # at most 729 rows
    counts = [1.0] * 729
    for r in rows:
        counts[r.cell] += r.n
    return [math.log(c / sum(counts[i // 27 * 27 : i // 27 * 27 + 27])) for i, c in enumerate(counts)]


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """candidate, covered: characters in letter runs that are dictionary words."""
    runs = found.select("candidate").distinct().select(
        "candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(FRAGMENT), F.lit(0))).alias("word")
    )
    known = words.where(F.col("n") >= DICTIONARY_COUNT).select("word")
    return runs.join(known, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with a column for every one of ``FEATURES``."""
    c, n = F.col("candidate"), F.length("candidate")
    table = F.lit(transitions(words)).cast("array<double>")
    low = F.lower(c)
    char = lambda s, i: F.substring(s, i, F.lit(1))

    def kind(s: Column) -> Column:
        return F.when(s.between("0", "9"), 0).when(s.between("a", "z"), 1).when(s.between("A", "Z"), 2).otherwise(3)

    steps = F.sequence(F.lit(1), n - 1)
    changes = F.aggregate(steps, F.lit(0), lambda a, i: a + (kind(char(c, i)) != kind(char(c, i + 1))).cast("int"))
    chance = F.aggregate(
        steps, F.lit(0.0), lambda a, i: a + F.get(table, (_code(char(low, i)) * 27 + _code(char(low, i + 1))).cast("int"))
    )
    share = lambda pattern: F.length(F.regexp_replace(c, pattern, "")) / n
    covered = coverage(found, words).select(F.col("candidate").alias("of"), "covered")
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    rows = found.join(covered, F.col("candidate") == F.col("of"), "left")
    return rows.select(
        *found.columns,
        n.cast("double").alias("length"),
        share("[^0-9]").alias("digit_share"),
        share("[^A-Z]").alias("upper_share"),
        share("[A-Za-z0-9]").alias("symbol_share"),
        (changes / n).alias("class_changes"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct_share"),
        flag(c.rlike("^[0-9a-fA-F]+$")).alias("hex_only"),
        (chance / F.greatest(n - 1, F.lit(1))).alias("transition"),
        (F.coalesce("covered", F.lit(0)) / n).alias("coverage"),
        (n - F.length(F.replace(c, F.lit("/"), F.lit("")))).cast("double").alias("slashes"),
        F.size(F.split("path", "/")).cast("double").alias("path_depth"),
        flag(F.col("path").rlike(TEST_PATH)).alias("test_path"),
        flag(F.col("before").rlike(CREDENTIAL)).alias("credential_before"),
        flag(F.col("before").rlike(ASSIGNMENT)).alias("assigned"),
        flag(F.col("before").rlike("[\"']$")).alias("quoted"),
        F.length(F.regexp_extract("before", r"(\S*)\s*$", 1)).cast("double").alias("word_before"),
        F.length(F.regexp_extract("after", r"^\S?\s*(\S*)", 1)).cast("double").alias("word_after"),
    )


def distant_labels(rows: DataFrame, max_labelled: int) -> DataFrame:
    """Labelled findings from the candidates' own contexts. In every other row,
    by a hash, the context is hidden: no marks, neighbours of arbitrary length."""
    by = F.xxhash64("candidate", "before")
    hide = F.pmod(by, F.lit(2)) == 0
    hidden = {
        "word_before": F.pmod(F.shiftright(by, 8), F.lit(12)).cast("double"),
        "word_after": F.pmod(F.shiftright(by, 24), F.lit(12)).cast("double"),
    }
    chosen = (
        rows.withColumn("label", F.when(F.col("coverage") < PROSE_COVERAGE, F.col("credential_before")).otherwise(0.0))
        .orderBy(F.xxhash64("doc_id", "start", "candidate"), "doc_id", "start", "candidate")
        .limit(max_labelled)
    )

    def seen(f: str) -> Column:
        return F.when(hide, hidden.get(f, F.lit(0.0))).otherwise(F.col(f)).alias(f) if f in CONTEXT else F.col(f)

    return chosen.select("label", *map(seen, FEATURES))


def scan(
    docs: DataFrame,
    path_col: str | None = None,
    labelled: DataFrame | None = None,
    max_labelled: int = 20_000,
    trees: int = 40,
    depth: int = 6,
    least: float = 0.5,
    seed: int = 11,
) -> DataFrame:
    """One row per candidate: doc_id, start, end, candidate, path, probability
    and ``is_secret`` (probability at least ``least``). ``labelled`` has
    ``label`` and the columns of ``FEATURES``."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    words = staged(word_counts(docs), "secret-words")
    found = staged(candidates(docs, path_col), "secret-candidates")
    rows = staged(described(found, words), "secret-features")
    vector = array_to_vector(F.array(*FEATURES)).alias("features")
    known = labelled if labelled is not None else distant_labels(rows, max_labelled)
    known = staged(known.limit(max_labelled).select("label", *FEATURES), "secret-labels")
    classes = [r.label for r in known.select("label").distinct().collect()]  # two values
    out = ["doc_id", "start", "end", "candidate", "path"]
    if len(classes) < 2:
        only = F.lit(float(classes[0]) if classes else 0.0)
        rated = rows.select(*out, only.alias("probability"))
    else:
        # at most max_labelled rows, in one order, so that the same input grows the same forest
        train = known.coalesce(1).sortWithinPartitions("label", *FEATURES).select("label", vector)
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label").fit(train)
        rated = forest.transform(rows.select(*out, vector)).select(
            *out, vector_to_array("probability")[1].alias("probability")
        )
    return rated.withColumn("is_secret", F.col("probability") >= least)
