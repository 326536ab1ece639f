"""URL filter: host and path rules, and association rules mined from labelled URLs, in DataFrame operations only.

A list of (host, path) rules gives verdicts; the longest rule that fits wins. For the URLs it leaves
open, FP-growth mines combinations of URL tokens from labelled URLs: every host label with its place
from the end, every directory with its place, the file name, its extension and the name of every
query field, all without numbers. Rules whose consequence is ``block`` or ``allow`` are kept if their support and confidence
are high enough and no rule on part of its tokens is as confident. They match through an inverted index:
each rule stands under its rarest token, a URL looks its tokens up, and the rest of the rule is
verified in the row. The most confident rule decides (block at a tie); without one the URL is allowed.

All combinations that are frequent enough are found, however many tokens a URL has; their number can double with every token
that labelled URLs may or may not have. Three steps that lose no rule come first: tokens that stand in the same labelled URLs are one
item (a rule lists its tokens as ``members``, any of which fits); an item that alone settles the label needs no company, so it is a
rule and leaves the combinations; and so does an item that all labelled URLs have, which changes no confidence.
FP-growth then counts what is left, spread over tasks by item, and rules are pruned size by size in joins that grow with the number
of sets found.

Defined cases: a URL that is null or has no ``://`` has empty host and path and no token, and is
allowed. With no labelled URL nothing is mined. Repeated rows are judged alike; null labels teach
nothing. Columns other than page_id and url are not read.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from kinweave.llm.tables import written

# Fixed values: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.9


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path and the query string of every URL."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    part = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    return part.select(
        "page_id",
        F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1).alias("fields"),
    )


def listed_rule(rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits host and path as (rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for host, path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens() -> Column:
    """The distinct tokens of every host label, path segment and query field; numbers are no part of a token."""
    def named(kind, value):
        return F.concat(F.lit(kind), F.regexp_replace(value, r"[0-9]+", "0"))

    none = F.array().cast("array<string>")
    host = F.transform(F.reverse(F.split("host", r"\.")), lambda label, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), label))
    # "0" stands for any number, so a directory that is a number is one token
    first = F.regexp_extract("path", r"^/([^/]*)/", 1)
    # behind the first directory each has its place; what follows the last slash is the file's name
    inner = F.split(F.regexp_extract("path", r"(?s)^/[^/]*/(.*)/", 1), "/")
    further = F.transform(inner, lambda part, i: F.when(part != "", F.concat(F.lit("d"), (i + 1).cast("string"), named(":", part))))
    name = F.regexp_extract("path", r"(?s)([^/]+?)(?:\.[A-Za-z0-9]{1,8})?$", 1)
    extension = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1)
    fields = F.filter(F.split("fields", "&"), lambda f: f != "")
    present = F.concat(
        host, F.when(first != "", F.array(named("d:", first))).otherwise(none), F.filter(further, lambda part: part.isNotNull()),
        F.when(name != "", F.array(named("n:", name))).otherwise(none), F.when(extension != "", F.array(named("x:", extension))).otherwise(none),
        F.transform(fields, lambda f: named("q:", F.regexp_extract(f, r"^([^=]*)", 1))))
    return F.when(F.col("host") != "", F.array_distinct(present)).otherwise(none)


def same_urls(labelled: DataFrame, min_support: float) -> DataFrame:
    """item, members: the frequent tokens of ``labelled`` (tokens, label, n), those of the same URLs under the least of them."""
    total = labelled.agg(F.sum("n")).first()[0] or 0
    marks = [F.xxhash64("tokens", "label"), F.xxhash64(F.lit(1), "tokens", "label")]
    places = labelled.select("n", marks[0].alias("mark"), marks[1].alias("mark_2"), F.explode("tokens").alias("token"))
    # the rows of ``labelled`` are distinct, so equal sums and marks mean the same rows
    found = places.groupBy("token").agg(F.sum("n").alias("n"), F.bit_xor("mark").alias("mark"), F.bit_xor("mark_2").alias("mark_2"))
    found = found.where(F.col("n") >= F.lit(min_support * total))
    return found.groupBy("n", "mark", "mark_2").agg(F.sort_array(F.collect_list("token")).alias("members")).select(
        F.col("members")[0].alias("item"), "members")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, antecedent (items), members (of each item), label, confidence, support from rows of ``tokens`` and ``label``.

    A rule is pruned if part of its items gives the same label at least as surely.
    """
    labelled = labelled.where(F.col("label").isNotNull())
    kinds = written(labelled.groupBy("tokens", "label").agg(F.count("*").alias("n")), "url-kinds")
    total = kinds.agg(F.sum("n")).first()[0] or 0
    items_of = written(same_urls(kinds, min_support), "url-items")
    counted = written(item_counts(kinds, items_of), "url-item-counts")
    alone = counted.where((F.col("n") >= min_support * total) & (F.col("n") >= min_confidence * F.col("n_item"))).select(
        F.array("item").alias("antecedent"), "label", (F.col("n") / F.col("n_item")).alias("confidence"), (F.col("n") / total).alias("support"))
    # the items that can gain by company; at most what support allows: tokens a URL / min_support names
    gaining = counted.where((F.col("n") < F.col("n_item")) & (F.col("n_item") < total))
    names = sorted(row["item"] for row in gaining.select("item").distinct().collect())
    there = F.array_intersect(F.lit(names) if names else F.array().cast("array<string>"), F.col("tokens"))
    chosen = labelled.select("label", there.alias("there")).where(F.size("there") > 1)
    rules = with_ids(alone)
    if not chosen.isEmpty():
        n_chosen = chosen.count()
        items = chosen.select(F.concat("there", F.array(F.concat(F.lit("="), "label"))).alias("items"))
        # the support is a share of all labelled rows, and FP-growth sees those with a combination
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, min_support * total / n_chosen)).fit(items)
        rules = prune(written(rules, "url-rules"), written(labelled_sets(model.freqItemsets, total), "url-sets"), min_confidence)
    return with_members(written(rules, "url-rules"), items_of)


def labelled_sets(found: DataFrame, total: int) -> DataFrame:
    """The frequent sets (items, freq) of two items at least and a label, as rules with their size, confident or not."""
    sets = written(found.select(
        F.sort_array(F.filter("items", lambda item: ~item.startswith("="))).alias("antecedent"),
        F.get(F.filter("items", lambda item: item.startswith("=")), F.lit(0)).alias("label"), F.col("freq").alias("n")), "url-item-sets")
    sets = sets.where(F.size("antecedent") > 1)
    of_all = sets.where(F.col("label").isNull()).select("antecedent", F.col("n").alias("n_item"))
    rows = sets.where(F.col("label").isNotNull()).join(of_all, "antecedent").select(
        "antecedent", F.expr("substring(label, 2)").alias("label"), (F.col("n") / F.col("n_item")).alias("confidence"), (F.col("n") / total).alias("support"))
    return with_ids(rows).withColumn("size", F.size("antecedent"))


def with_ids(rules: DataFrame) -> DataFrame:
    return rules.select(F.xxhash64("label", "antecedent").alias("rule_id"), "antecedent", "label", "confidence", "support")


def item_counts(kinds: DataFrame, items_of: DataFrame) -> DataFrame:
    """item, label, n and n_item: the labelled rows with an item, of one label and of all. Its least member stands for an item."""
    rows = kinds.select("label", "n", F.explode("tokens").alias("item")).join(items_of.select("item"), "item")
    by_label = rows.groupBy("item", "label").agg(F.sum("n").alias("n"))
    return by_label.join(by_label.groupBy("item").agg(F.sum("n").alias("n_item")), "item")


def prune(alone: DataFrame, sets: DataFrame, min_confidence: float) -> DataFrame:
    """The rules of one item and those ``sets`` that are rules, less those of which a proper part is a rule that gives the same label
    at least as surely.

    Every part of a frequent set is frequent, so the best confidence below a set is the best of its parts with one item less: a
    join by id a size.
    """
    kept, best = [alone], alone.select(F.col("rule_id").alias("part_id"), F.col("confidence").alias("best"))
    for size in range(2, (sets.agg(F.max("size")).first()[0] or 0) + 1):
        level = sets.where(F.col("size") == size).drop("size")
        parts = F.transform("antecedent", lambda item: F.xxhash64("label", F.array_remove("antecedent", item)))
        below = level.select("rule_id", F.explode(parts).alias("part_id")).join(best, "part_id").groupBy("rule_id").agg(F.max("best").alias("below"))
        sure = F.when(F.col("confidence") >= min_confidence, F.col("confidence"))
        judged = level.join(below, "rule_id", "left").withColumn("best", F.greatest("below", sure))
        judged = written(judged.where(F.col("best").isNotNull()), "url-judged-sets")
        new = judged.where((F.col("confidence") >= min_confidence) & (F.col("below").isNull() | (F.col("below") < F.col("confidence"))))
        kept.append(new.select(*alone.columns))
        best = judged.select(F.col("rule_id").alias("part_id"), "best")
    return reduce(DataFrame.unionByName, kept)


def with_members(rules: DataFrame, items_of: DataFrame) -> DataFrame:
    """Add ``members``: the tokens of each item of the antecedent."""
    members = rules.select("rule_id", F.explode("antecedent").alias("item")).join(items_of, "item").groupBy("rule_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("item", "members"))), lambda x: x["members"]).alias("members"))
    return rules.join(members, "rule_id")


def with_rarest(rules: DataFrame) -> DataFrame:
    """The rules with the item of their antecedent that the fewest rules use, as column rarest."""
    uses = rules.select(F.explode("antecedent").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    rarest = rules.select("rule_id", F.explode("antecedent").alias("token")).join(uses, "token").groupBy("rule_id").agg(
        F.min(F.struct("uses", "token")).alias("least"))
    return rules.join(rarest, "rule_id").withColumn("rarest", F.col("least.token")).drop("least")


def rule_hits(urls: DataFrame, rules: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The rules that rows of ``urls`` (page_key, tokens) match; a rule repeats for a URL with several tokens of the item it stands under.

    The index is a written table, so a hot token can be split.
    """
    at = F.array_position("antecedent", F.col("rarest")).cast("int") - 1
    index = written(with_rarest(rules).select(F.explode(F.get("members", at)).alias("token"), *[
        name for name in ("rule_id", "members", "label", "confidence") if name in rules.columns]), "url-index")
    looked_up = urls.select("page_key", "tokens", *carried, F.explode("tokens").alias("token")).join(index, "token")
    verified = looked_up.where(F.forall("members", lambda any_of: F.arrays_overlap(any_of, F.col("tokens"))))
    return verified


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """page_key and the best rule's label and confidence, for the rows of ``urls`` (page_key, tokens) that match one."""
    best = F.max(F.struct("confidence", "label"))
    return rule_hits(urls, rules).groupBy("page_key").agg(best.alias("best")).select("page_key", "best.label", "best.confidence")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict. The verdicts of the listed rules are the labels that are mined."""
    found = with_parts(pages).withColumn("listed", listed_rule(rules)).select(
        "page_id", "host", "path", "listed", tokens().alias("tokens"))
    found = written(found.withColumn("page_key", F.monotonically_increasing_id()), "urls")
    labelled = found.where(F.col("listed").isNotNull()).select("tokens", F.col("listed.verdict").alias("label"))
    open_ = found.where(F.col("listed").isNull() & (F.size("tokens") > 0)).select("page_key", "tokens")
    if labelled.isEmpty():
        mined = found.select("page_key", F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("confidence")).limit(0)
    else:
        mined = match_rules(open_, mine_rules(labelled, min_support, min_confidence))
    return found.join(mined, "page_key", "left").select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "label", F.lit("allow")).alias("verdict"), "confidence")
