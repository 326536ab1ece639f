"""Quality rules of documents and of their hosts, as DataFrame expressions only.

Every document is measured and held against RULES. Per host (the ``source`` column) the failures of
each rule are added up. A rate of a host with few documents says little, so it is shrunk: over all
hosts a beta prior is fitted by moments, and the posterior mean of the rate is compared with the
limit. Documents of a host that fails any rule go, besides those that fail by themselves.

The measures are written once, without texts. Counts per host collapse before the shuffle, and only
failing hosts are joined back, so a host with a third of all documents is a few rows either way.

Defined cases: null text has no words and fails the length rule; documents with a null source have no host and
are judged by themselves. Repeated rows count as often as they occur. An empty table gives an empty result.
A text's repeated windows are found by sorting the windows' 64-bit hashes within its row.
"""

from pyspark.sql import Column, DataFrame, functions as F

from kinweave.llm.tables import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
HOST_LIMIT = 0.5
STRONGEST = 1e6


def measures(documents: DataFrame, *kept: str) -> DataFrame:
    """doc_id, n_words, n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split("whole", SPACE), lambda w: w != "")
    lines = F.filter(F.split("whole", "\n"), lambda line: F.translate(line, " \t\n\x0b\f\r", "") != "")
    split = documents.select("doc_id", *kept, text.alias("whole")).select(
        "doc_id", *kept,
        F.length(F.translate("whole", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("whole") - F.length(F.translate("whole", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                         (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        _bound(words, lambda x: F.struct(F.size(x).cast("long").alias("n"), repeated_words(x).alias("repeat"))).alias("words"),
    )
    return split.select(
        "doc_id", *kept, F.col("words.n").alias("n_words"), F.col("lines.n").alias("n_lines"), "word_chars", "n_symbols",
        F.col("lines.dup").alias("n_dup_lines"), F.col("words.repeat").alias("n_repeat_words"))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Number of words inside windows of WINDOW words that occur twice or more in the array."""
    last = F.size(words) - WINDOW
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)]))
    counted = _bound(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                     .otherwise(_covered(w)))
    return F.when(last < 0, F.lit(0).cast("long")).otherwise(counted)


def _covered(windows: Column) -> Column:
    """Words under the windows whose hash stands in the array twice or more."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(rows):
        def near(row, k):
            before = F.when(k > 0, rows[k - 1]["h"])
            after = F.when(k < F.size(rows) - 1, rows[k + 1]["h"])
            return row["h"].eqNullSafe(before) | row["h"].eqNullSafe(after)
        return F.sort_array(F.transform(F.filter(rows, near), lambda row: row["i"]))

    def add(state, at):
        end = at + WINDOW
        return F.struct((state["n"] + end - F.greatest(at, state["end"])).cast("long").alias("n"), end.alias("end"))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(_bound(placed, twice), start, add, lambda state: state["n"])


def rules() -> dict[str, Column]:
    """Rules by name; true where a document fails."""
    n_words = F.col("n_words")
    return {
        "too_short": n_words < 10,
        "repetitive": 100 * F.col("n_repeat_words") > 20 * n_words,
        "duplicate_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "symbols": 10 * F.col("n_symbols") > n_words,
        "word_length": (F.col("word_chars") < 2 * n_words) | (F.col("word_chars") > 20 * n_words),
    }


# Rules that a document must pass by itself; the others count for its host.
OWN_RULES = ("too_short", "repetitive")


def host_rates(judged: DataFrame) -> DataFrame:
    """source, n_docs, failures and shrunk rates of every host; ``judged`` has a column per rule."""
    names = list(rules())
    hosts = judged.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count("*").alias("n_docs"), *[F.sum(F.col(f"fails_{name}").cast("long")).alias(name) for name in names])
    rate = {name: F.col(name) / F.col("n_docs") for name in names}
    over_hosts = hosts.agg(*[
        part for name in names for part in (
            (F.sum(name) / F.sum("n_docs")).alias(f"mean_{name}"),
            (F.avg(rate[name] * rate[name]) - F.avg(rate[name]) * F.avg(rate[name])).alias(f"var_{name}"))
    ]).first()
    shrunk = []
    for name in names:
        alpha, strength = beta_prior(over_hosts[f"mean_{name}"], over_hosts[f"var_{name}"])
        shrunk.append(((F.col(name) + alpha) / (F.col("n_docs") + strength)).alias(f"rate_{name}"))
    return hosts.select("source", "n_docs", *names, *shrunk)


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """alpha and alpha + beta of the beta distribution with these moments; very strong if hosts do not differ."""
    if mean is None or not 0 < mean < 1:
        return float(mean or 0) * STRONGEST, STRONGEST
    strength = mean * (1 - mean) / max(variance or 0.0, 1e-12) - 1
    strength = min(max(strength, 1.0), STRONGEST)
    return mean * strength, strength


def judge(documents: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """The measures of every document, base_failed, and kept after the host's verdict."""
    found = written(measures(documents, "source"), "quality-measures")
    judged = found.select("*", *[failed.alias(f"fails_{name}") for name, failed in rules().items()])
    rates = host_rates(judged)
    worst = F.greatest(*[F.col(f"rate_{name}") for name in rules()])
    # a written table, so that both sides of the join are plain shuffles and a hot host's documents can be split
    failing = written(rates.where(worst > host_limit).select("source", F.lit(True).alias("host_failed")), "quality-failing")
    base_failed = F.col("fails_too_short") | F.col("fails_repetitive")
    return judged.join(failing, "source", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("host_failed").isNull()).alias("kept"))
