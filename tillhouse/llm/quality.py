"""Quality rules: figures of each text, and lines that too many documents of a host repeat.

Lines are compared in a normal form (lower case, digits as zero, single spaces) by a hash that covers the host too.
A line is boilerplate of its host when at least ``min_docs`` of the host's documents hold it, and either more than
``max_share`` of them do or more than ``max_docs``, which is what counts in a large host. Documents with equal texts count once, so a document isn't rejected for having copies: removing these is
the work of the near-duplicate operators. Boilerplate lines are removed, and a document with too few words left is
rejected.

Only built-in functions are used. Every document is read whole; what is shuffled is one narrow row for each distinct
line of a document, combined before the shuffle when lines are counted.

Defined results: a NULL text counts as empty; an empty text has zero in every figure and fails; a NULL host is a host
of its own; rows repeated in full share their verdict; an empty table gives an empty result; other columns of the input
are ignored by ``quality_rules`` and kept by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import SPACE, WORD, fresh, let, word_count, words
from tillhouse.session import staged

WINDOW = 5  # words of a window that may not repeat
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
MIN_DOCS = 20
MAX_SHARE = 0.1
MAX_DOCS = 50
MIN_LEFT = 0.3
SYMBOLS = "#*$%&|<>"

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def normal_line(line: Column) -> Column:
    squeezed = F.regexp_replace(F.regexp_replace(line, "[0-9]", "0"), SPACE, " ")
    return F.lower(F.trim(squeezed))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _has_word(line: Column) -> Column:
    return line.rlike(WORD)


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more; ``hashes`` are those of all windows in order."""

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def repeated(order: Column) -> Column:
        alike = lambda x, other: F.coalesce(other["h"] == x["h"], F.lit(False))
        twice = F.filter(order, lambda x, i: alike(x, F.get(order, i - 1)) | alike(x, F.get(order, i + 1)))
        return let(F.array_sort(F.transform(twice, lambda x: x["i"])), covered)

    order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(order, repeated))


def text_metrics(text: Column) -> Column:
    """A struct of ``METRICS``.

    It is one expression that binds words and windows once, so that nothing is computed anew for each element, wherever
    the planner moves it.
    """
    body = F.coalesce(text, F.lit(""))

    def windows(w: Column) -> Column:
        starts = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(0), F.size(w) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)]))

    def figures(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
            let(F.filter(_lines(body), _has_word), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            let(windows(w), _repeated_words).cast("bigint").alias("n_repeat_words"),
        )

    return let(words(text), figures)


def host_lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """A table of all lines that hold a word: host, row_key, pos, line (hash), n (words)."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    lines = rows.select("host", row_key(F.col("host"), F.col("text")).alias("row_key"), F.posexplode(_lines(body)).alias("pos", "line"))
    return staged(lines.filter(_has_word(F.col("line"))).select(
        "host", "row_key", "pos", line_key(F.col("host"), F.col("line")).alias("line"), word_count(F.col("line")).alias("n")), "lines")


def boilerplate(lines: DataFrame, hosts: DataFrame, min_docs: int, max_share: float, max_docs: int) -> DataFrame:
    """The rows of ``lines`` that are boilerplate of their host; ``hosts`` has host and row_key of all documents."""
    sizes = hosts.groupBy(F.col("host").alias("of")).agg(F.countDistinct("row_key").alias("host_docs"))
    common = (
        lines.groupBy("line", "host").agg(F.countDistinct("row_key").alias("docs"))
        .join(sizes, F.col("host").eqNullSafe(F.col("of")))
        .filter((F.col("docs") >= min_docs) & (F.col("docs") > F.least(max_share * F.col("host_docs"), F.lit(float(max_docs)))))
        .select("line")
    )
    return lines.join(common, "line", "left_semi")


def row_key(host: Column, text: Column) -> Column:
    return F.xxhash64(host, F.coalesce(text, F.lit("")))


def line_key(host: Column, line: Column) -> Column:
    return F.xxhash64(host, normal_line(line))


def _rows(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"))
    return rows.withColumn("_key", row_key(F.col("host"), F.col("text")))


def _bad_lines(docs: DataFrame, text: str, host: str, min_docs: int, max_share: float, max_docs: int) -> tuple[DataFrame, DataFrame]:
    hosts = docs.select(F.col(host).cast("string").alias("host"), row_key(F.col(host).cast("string"), F.col(text)).alias("row_key"))
    lines = host_lines(docs, text, host)
    return lines, boilerplate(lines, hosts, min_docs, max_share, max_docs)


def _line_words(lines: DataFrame, name: str) -> DataFrame:
    """row_key and the words in these lines; rows with equal texts have one row here."""
    return lines.select("row_key", "pos", "n").distinct().groupBy("row_key").agg(F.sum("n").alias(name))


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the metrics, base_failed, words_left, kept."""
    _, bad = _bad_lines(docs, text, host, min_docs, max_share, max_docs)
    removed = _line_words(bad, "removed")
    rows = _rows(docs, doc_id, text, host).select("doc_id", "_key", text_metrics(F.col("text")).alias("m"))
    figures = rows.select("doc_id", "_key", "m.*")
    return (
        figures.join(removed, F.col("_key") == F.col("row_key"), "left")
        .withColumn("words_left", F.col("n_words") - F.coalesce(F.col("removed"), F.lit(0)))
        .withColumn("base_failed", _failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("words_left") >= min_left * F.col("n_words")))
        .drop("_key", "row_key", "removed")
    )


def keep_good(
    docs: DataFrame, text: str = "text", host: str = "source",
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns and whole texts.

    Only the keys of rows that hold boilerplate meet the texts again.
    """
    whole = fresh(docs, "_row")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole),
        F.col(host).cast("string").alias("host"), F.col(text).alias("text"),
    ).withColumn("_key", row_key(F.col("host"), F.col("text")))
    lines, bad = _bad_lines(docs, text, host, min_docs, max_share, max_docs)
    removed = _line_words(bad, "removed")
    totals = _line_words(lines.join(removed, "row_key", "left_semi"), "n_words")
    depleted = removed.join(totals, "row_key").filter(F.col("n_words") - F.col("removed") < min_left * F.col("n_words"))
    depleted = staged(depleted.select(F.col("row_key").alias("_key")), "depleted")  # so that the planner knows its size
    passed = rows.withColumn("m", text_metrics(F.col("text"))).select(whole, "_key", "m.*").filter(~_failed())
    return passed.join(depleted, "_key", "left_anti").select(f"{whole}.*")


def without_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS,
) -> DataFrame:
    """doc_id and clean_text: the text without boilerplate lines, the text itself where it has none."""
    _, bad = _bad_lines(docs, text, host, min_docs, max_share, max_docs)
    bad = bad.groupBy("row_key").agg(F.collect_set("line").alias("bad_lines"))
    good = F.filter(_lines(F.col("text")), lambda x: ~(_has_word(x) & F.array_contains("bad_lines", line_key(F.col("host"), x))))
    rows = _rows(docs, doc_id, text, host).join(bad, F.col("_key") == F.col("row_key"), "left")
    clean = F.when(F.col("bad_lines").isNull(), F.col("text")).otherwise(F.array_join(good, "\n"))
    return rows.select("doc_id", clean.alias("clean_text"))
