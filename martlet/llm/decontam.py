"""Benchmark decontamination by template windows, in DataFrame functions only.

Texts become templates: numbers, units after numbers and capitalised words
within sentences turn into typed placeholders, other words are lower-cased.
Windows of ``window`` template words are hash-joined with the benchmark's.
Where a matched window has placeholders, the values in them are compared: on
one alignment of document and item each benchmark value must stand for one
document value throughout, which re-parameterised questions satisfy and chance
matches do not. An item is found in a document if ``similarity`` of its windows
are, or a run of ``min_run`` words of it is.

With ``verbatim``, as the registered query and the pipeline have it, a window is
also found where its plain lower-cased words are, whatever placeholders case and
punctuation lead to. Such windows and those without placeholders always count;
contradicting values then drop only the windows whose values differ.

Windows with fewer than ``min_words`` words beside placeholders match on their
values instead (by default those of placeholders alone, as any list of numbers has
them; the comparison of values and the share of windows reject chance matches of
the others); items shorter than a window are matched as one window of their
own length. Punctuation, case and white space do not matter.

Defined cases: null or empty texts match nothing; documents with the same id
and text are one document in the result; other rows that share an id are
examined apart and give a row each; items are named by ``item_id``, repeated or
null items included; empty tables give no rows. Texts are read whole. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import documents, quoted, staged

WINDOW = 5
SIMILARITY = 0.8
MIN_RUN = 13
MIN_WORDS = 1
#: Units that count as such after a number.
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "cl", "l", "s", "sec", "seconds", "min", "minutes", "h",
    "hours", "days", "weeks", "months", "years", "percent", "dollars", "euros", "eur", "usd", "miles", "feet",
    "inches", "pounds", "ounces", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb", "w", "kw", "v", "a",
)
#: Stands before names in prepared words and before every placeholder.
MARK = "\u0002"


def prepared(text: Column) -> Column:
    """Words separated by one space: names marked, numbers whole, everything
    that is neither letter, digit nor a number's own separator removed."""
    text = F.replace(text, F.lit(MARK), F.lit(" "))
    # a capital after a small letter, digit, comma or semicolon and a space is within a sentence
    # every pattern first tests the character at hand, which fails at most of them
    marked = F.regexp_replace(text, r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;]\s)", MARK)
    apart = F.regexp_replace(marked, r"(\p{N})(?=\p{L})", "$1 ")
    # two passes of plain classes: a repeated choice would take stack for every character of a run
    lone = F.regexp_replace(apart, r"[.,](?:(?!\p{N})|(?<!\p{N}[.,]))", " ")
    return F.trim(F.regexp_replace(lone, rf"[^\p{{L}}\p{{N}}{MARK}.,]++", " "))


def template(words: Column) -> Column:
    """The words of ``prepared`` with placeholders for names, numbers and units."""
    named = F.regexp_replace(words, rf"{MARK}\S+", f"{MARK}name")
    counted = F.regexp_replace(named, r"(?=\p{N})(?<![^ ])\p{N}\S*", f"{MARK}num")
    united = F.regexp_replace(counted, rf"({MARK}num )(?i:{'|'.join(UNITS)})(?![^ ])", f"$1{MARK}unit")
    return F.lower(united)


def windows(df: DataFrame, keep: list[str], sizes: list[int], min_words: int, verbatim: bool) -> DataFrame:
    """``keep``, p (from 0) and, for each size s, the hashes of the window that
    begins there: ``t<s>`` of its template and ``o<s>`` of its plain words (without
    ``verbatim``: its words), each null where it doesn't count.

    Each word is hashed once; windows are hashed from their words' hashes, and their
    literal words counted, in compiled code, for all sizes in one pass."""
    # the lowest bit marks placeholders
    flagged = F.transform(
        "templates", lambda t: F.xxhash64(t).bitwiseAND(-2).bitwiseOR(F.when(t.startswith(MARK), 1).otherwise(0).cast("long"))
    )
    other = F.transform("plain" if verbatim else "words", lambda w: F.xxhash64(w))
    hashed = df.select(*keep, flagged.alias("_t"), other.alias("_o"))
    rows = hashed.select("*", F.explode(F.sequence(F.lit(0), F.size("_t") - 1)).alias("p"))
    columns = []
    for size in sizes:
        t = [F.get("_t", F.col("p") + k) for k in range(size)]
        o = [F.get("_o", F.col("p") + k) for k in range(size)]
        literal = sum((x.bitwiseAND(1) == 0).cast("int") for x in t)
        enough = literal >= min(min_words, size)
        whole = F.size("_t") >= F.col("p") + size
        # the common window has no placeholder at all: its plain words are its template
        as_template = whole & enough & (literal < size) if verbatim else whole & enough
        as_words = whole if verbatim else whole & ~enough
        columns.append(F.when(as_template, F.xxhash64(F.lit(size), *t)).alias(f"t{size}"))
        columns.append(F.when(as_words, F.xxhash64(F.lit(-size), *o)).alias(f"o{size}"))
    return rows.select(*keep, "p", *columns)


def slots(templates: Column, words: Column, at: Column, size: Column) -> Column:
    """The values under a window's placeholders, in order."""
    pairs = F.arrays_zip(F.slice(templates, at, size).alias("t"), F.slice(words, at, size).alias("w"))
    return F.transform(
        F.filter(pairs, lambda p: p["t"].startswith(MARK)),
        lambda p: F.concat_ws(":", F.substring(p["t"], 2, 4), F.lower(F.replace(p["w"], F.lit(MARK), F.lit("")))),
    )


def _split(df: DataFrame) -> DataFrame:
    df = df.withColumn("words", prepared(F.col("text")))
    df = df.withColumn("plain", F.split(F.lower(F.replace(F.col("words"), F.lit(MARK), F.lit(""))), " "))
    return df.withColumn("templates", F.split(template(F.col("words")), " ")).withColumn("words", F.split("words", " "))


def item_windows(items: DataFrame, window: int, min_words: int, verbatim: bool = False) -> DataFrame:
    """item, at, size, hash, same (hash of plain words), slots of the item's windows."""
    split = _split(documents(items, "item_id")).select(F.col("doc_id").alias("item"), "words", "templates", "plain")
    split = split.where(F.element_at("words", 1) != "").withColumn("full", F.least(F.lit(window), F.size("words")))
    # the items' words beside their windows: items are few and short next to documents
    sizes = list(range(1, window + 1))
    every = windows(split, ["item", "words", "templates", "plain", "full"], sizes, min_words, verbatim)
    entries = [
        F.struct(F.lit(s).alias("size"), F.col(f"{kind}{s}").alias("hash"), F.lit(verbatim and kind == "o").alias("same"))
        for s in sizes
        for kind in "to"
    ]
    entries = every.select("item", "words", "templates", "full", "p", F.inline(F.array(*entries))).where("hash is not null")
    out = entries.where(F.col("size") == F.col("full")).select(
        "item",
        (F.col("p") + 1).alias("at"),
        "size",
        "hash",
        "same",
        F.when(F.col("same"), F.array().cast("array<string>"))
        .otherwise(slots(F.col("templates"), F.col("words"), F.col("p") + 1, F.col("size")))
        .alias("slots"),
    )
    # repeated items name the same windows once
    return out.dropDuplicates(["item", "at", "hash"])


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    min_run: int = MIN_RUN,
    min_words: int = MIN_WORDS,
    verbatim: bool = False,
) -> DataFrame:
    """One row per document and item found in it: doc_id, tie (hash of the
    text), item_id, found and item windows, longest run in words, and whether
    values differ from the benchmark's (``reparameterised``)."""
    bench = staged(item_windows(items, window, min_words, verbatim), "benchmark-windows")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most ``window`` values
    texts = documents(docs).withColumn("tie", F.xxhash64("text"))
    keys = bench.select(
        "hash", F.col("item"), F.col("at").alias("item_at"), "size", "same", F.size("slots").alias("n_slots")
    ).withColumnRenamed("same", "copied")

    found = windows(_split(texts), ["doc_id", "tie"], sizes or [window], min_words, verbatim)
    hashes = F.array(*[F.col(f"{kind}{s}") for s in sizes or [window] for kind in "to"])
    exploded = found.select("doc_id", "tie", "p", F.explode(hashes).alias("hash"))
    # the hash tells size and kind; the staged size of the benchmark decides between
    # a broadcast and a shuffled join, in which null hashes match nothing
    hits = exploded.join(keys, "hash").select(
        "doc_id", "tie", "item", (F.col("p") + 1).alias("doc_at"), "item_at", "size", "copied", "n_slots"
    )
    # a window copied word for word has no values to compare
    hits = hits.groupBy("doc_id", "tie", "item", "doc_at", "item_at", "size").agg(
        F.when(F.max("copied"), F.lit(0)).otherwise(F.max("n_slots")).alias("n_slots")
    )
    hits = staged(hits, "benchmark-hits")

    # only windows with placeholders have values to compare; staged, so that the
    # texts are shuffled for them only if there are too many to broadcast
    slotted = hits.where("n_slots > 0")
    places = staged(
        slotted.groupBy(F.col("doc_id").alias("d"), F.col("tie").alias("h")).agg(
            F.collect_set(F.struct("doc_at", "size")).alias("places")
        ),
        "benchmark-places",
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("h"))
    values = (
        _split(texts.join(places, same))
        .select("d", "h", "templates", "words", F.explode("places").alias("p"))
        .select(
            "d",
            "h",
            F.col("p.doc_at").alias("da"),
            F.col("p.size").alias("sz"),
            slots(F.col("templates"), F.col("words"), F.col("p.doc_at"), F.col("p.size")).alias("doc_slots"),
        )
        .distinct()
    )
    of_item = bench.select(F.col("item").alias("i"), F.col("at").alias("ia"), "slots").where(F.size("slots") > 0)
    pairs = (
        slotted.join(values, same & (F.col("doc_at") == F.col("da")) & (F.col("size") == F.col("sz")))
        .join(of_item, F.col("item").eqNullSafe(F.col("i")) & (F.col("item_at") == F.col("ia")))
        .select(
            "doc_id",
            "tie",
            "item",
            (F.col("doc_at") - F.col("item_at")).alias("shift"),
            F.explode(F.arrays_zip(F.col("slots").alias("b"), F.col("doc_slots").alias("v"))).alias("pair"),
        )
    )
    alignment = ["doc_id", "tie", "item", "shift"]
    checked = (
        pairs.select(*alignment, "pair.b", "pair.v")
        .distinct()
        .groupBy(*alignment)
        .agg(
            F.count(F.lit(1)).alias("links"),
            F.count_distinct("b").alias("values"),
            F.max(F.col("b") != F.col("v")).alias("differs"),
        )
    )
    checked = checked.select(*[F.col(c).alias(f"c_{c}") for c in alignment], "links", "values", "differs")
    on = None
    for c in alignment:
        term = F.col(c).eqNullSafe(F.col(f"c_{c}"))
        on = term if on is None else on & term
    aligned = hits.withColumn("shift", F.col("doc_at") - F.col("item_at")).join(checked, on, "left")
    # values that contradict each other refute the windows that hold them, not those copied as they are
    kept = F.expr("links is null or links = values")
    aligned = aligned.where(kept | (F.col("n_slots") == 0) if verbatim else kept).select(
        *alignment,
        "item_at",
        "size",
        (F.coalesce("differs", F.lit(False)) & (F.lit(not verbatim) | (F.col("n_slots") > 0))).alias("differs"),
    )

    # runs of consecutive windows on one alignment; an alignment has at most an item's windows
    order = W.partitionBy(*alignment).orderBy("item_at")
    runs = (
        aligned.withColumn("island", F.col("item_at") - F.row_number().over(order))
        .groupBy(*alignment, "island")
        .agg((F.count(F.lit(1)) + F.first("size") - 1).alias("run"))
        .groupBy("doc_id", "tie", "item")
        .agg(F.max("run").alias("longest_run"))
    )
    # an item window counts once however often it is found
    found = (
        aligned.groupBy("doc_id", "tie", "item", "item_at")
        .agg(F.max("differs").alias("differs"))
        .groupBy("doc_id", "tie", "item")
        .agg(F.count(F.lit(1)).alias("found"), F.max("differs").alias("differs"))
    )
    totals = bench.groupBy(F.col("item").alias("t_item")).agg(F.count_distinct("at").alias("item_windows"))
    r = runs.select(F.col("doc_id").alias("r_d"), F.col("tie").alias("r_h"), F.col("item").alias("r_i"), "longest_run")
    joined = found.join(
        r,
        F.col("doc_id").eqNullSafe(F.col("r_d")) & (F.col("tie") == F.col("r_h")) & F.col("item").eqNullSafe(F.col("r_i")),
    ).join(totals, F.col("item").eqNullSafe(F.col("t_item")))
    return joined.where(
        (F.col("found") >= F.lit(similarity) * F.col("item_windows")) | (F.col("longest_run") >= min_run)
    ).select(
        "doc_id",
        "tie",
        F.col("item").alias("item_id"),
        F.col("found").cast("long").alias("found_windows"),
        F.col("item_windows").cast("long").alias("item_windows"),
        F.col("longest_run").cast("long").alias("longest_run"),
        F.col("differs").alias("reparameterised"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, **settings: float) -> DataFrame:
    """``docs`` less the documents in which an item was found."""
    bad = staged(contaminated(docs, items, **settings).select("doc_id", "tie").distinct(), "contaminated")
    tie = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), tie.alias("h")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("tie"))
    return rows.join(bad, same, "left_anti").select("row.*")
