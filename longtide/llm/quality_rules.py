"""Quality rules of documents and, from them, of hosts. DataFrame functions only.

A document's own rules count words, repeats and symbols. Failures are added up
by host, each host's rate is shrunk towards the corpus by a beta prior fitted
to the hosts' rates (method of moments), and the verdict on a host goes back
to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import others, whole
from .storage import materialise
from .words import WORD

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A host goes when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, k: int = WINDOW) -> Column:
    """Words that lie in windows of k words found twice or more in the array.

    Hashes of all windows show whether any may repeat. Only then are the windows
    themselves sorted with their positions, and equal neighbours counted, so no
    hash decides the result and no pair of windows is formed.
    """
    numbers = F.transform(words, lambda w: F.xxhash64(w))

    def windows(of, join):
        return F.transform(F.sequence(F.lit(0), F.size(of) - k), lambda i: join(of, i))

    def count(ws):
        keyed = F.sort_array(windows(ws, lambda of, i: F.struct(F.array_join(F.slice(of, i + 1, k), " ").alias("w"), i.alias("i"))))

        def covered(s):
            same = lambda j: F.get(s, j)["w"]
            found = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (same(j) == same(j - 1)) | (same(j) == same(j + 1)))
            return F.size(F.array_distinct(F.flatten(F.transform(found, lambda j: F.sequence(F.get(s, j)["i"], F.get(s, j)["i"] + k - 1)))))

        return _let(keyed, covered)

    hashed = _let(numbers, lambda of: windows(of, lambda x, i: F.xxhash64(F.slice(x, i + 1, k))))
    some = _let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= k, F.lit(0)).when(~some, F.lit(0)).otherwise(count(words)).cast("long")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Null text has no words. Columns of these names in docs are replaced.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(own, F.lit(WORD), F.lit(0))

    def measures(ws):
        return F.struct(F.size(ws).cast("long").alias("n_words"), repeated_words(ws).alias("n_repeat_words"))

    lines = F.filter(F.split(own, "\n"), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0)
    return (
        docs.withColumn("__m", _let(words, measures))
        .withColumn("n_words", F.col("__m.n_words"))
        .withColumn("word_chars", F.length(F.translate(own, SPACE_CHARS, "")).cast("long"))
        .withColumn("n_symbols", (F.length(own) - F.length(F.translate(own, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", F.col("__m.n_repeat_words"))
        .drop("__m")
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    )


def host_verdicts(flagged: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host of a table (host, base_failed): host, n_docs, n_failed, host_rate, host_kept.

    Prior: mean m and variance v of the hosts' rates give strength
    s = m (1 - m) / v - 1, at least 1; without spread, or with one host, the
    prior is as strong as the largest host. host_rate = (n_failed + m s) / (n_docs + s).
    The null host is a host.
    """
    hosts = flagged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    hosts = materialise(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    m, v, most = hosts.agg(F.sum("n_failed") / F.sum("n_docs"), F.var_pop(rate), F.max("n_docs")).first()  # three numbers
    m = m or 0.0
    strength = float(max(1.0, m * (1 - m) / v - 1) if v else most or 1)
    shrunk = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("host_rate"), (shrunk <= max_rate).alias("host_kept"))


def judged(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE, keep_text: bool = True) -> DataFrame:
    """base_rules(docs) with host_rate and kept: the document passes its own rules and its host is kept.

    docs and its measures are written once, without the text unless keep_text;
    text is parsed once. Columns of these names in docs are replaced.
    """
    own = docs.drop("host_rate", "kept", *MEASURES)
    flagged = base_rules(own.select(others(own, (text, host)), F.col(text).alias("text"), F.col(host).alias("host")))
    flagged = materialise(flagged if keep_text else flagged.drop("text"), "measured")
    hosts = host_verdicts(flagged.select("host", "base_failed"), "host", max_rate).select(F.col("host").alias("of"), "host_rate", "host_kept")
    out = flagged.join(hosts, flagged["host"].eqNullSafe(hosts["of"]), "left")
    columns = [F.col("text").alias(c) if c == text else F.col("host").alias(c) if c == host else F.col("doc")[c].alias(c) for c in own.columns if keep_text or c != text]
    return out.select(*columns, *MEASURES, "host_rate", (~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))).alias("kept"))


def quality_filter(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """docs without the rows that the rules reject, columns as they were, whatever their names and types."""
    flagged = base_rules(docs.select(whole(docs), F.col(text).alias("text"), F.col(host).alias("host")))
    flagged = materialise(flagged.select("doc", "host", "base_failed"), "measured")
    bad = host_verdicts(flagged, "host", max_rate).where(~F.col("host_kept")).select(F.col("host").alias("gone"))
    kept = flagged.where(~F.col("base_failed"))
    return kept.join(bad, kept["host"].eqNullSafe(bad["gone"]), "left_anti").select("doc.*")
