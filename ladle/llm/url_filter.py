"""Operator 12 [native]: URL verdicts by rules, and by a character language-model ratio where no rule fits.

Rules name a host and a path; a rule fits its host and all subdomains if the URL's path starts with
the rule's, and the longest fitting rule decides (ties: the first by text).  URLs that a rule accepts
or rejects are the examples of two Markov models over characters:

* every URL gives one gram for each character and its end: the character after the ORDER characters
  before it.  Grams are counted once, over all pages (partial sums before the shuffle); the counts of
  shorter contexts follow from this table, which has a row for each distinct gram.
* the models are of variable order: P(c | context) = (n(context, c) + d * P(c | shorter context)) /
  (n(context) + d), with d the distinct characters seen after the context, and the shorter context's
  value where the context was never seen; the empty context adds one to each of the characters.
* a URL's score is the mean over its grams of ln P_accepted - ln P_rejected.  Terms are whole
  millionths, so that a sum does not depend on its order.
* one fifth of the rule-decided URLs (by hash of the URL) is kept out of the counts and calibrates the
  threshold: the score bin that best separates accepted from rejected (Youden's index; ties: nearest
  to 0, then the lower).  Without examples of both sides the threshold is 0.

A URL without ``://`` (or null, scored as the empty text) has an empty host and path and fits no rule.
Empty and very long URLs, ties, repeated rows (each counts) and null page ids are ordinary rows; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ladle.llm.common import scratch_table

# The rules of the registered query.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
ORDER = 4
MILLION = 1_000_000
#: score bins in a unit of the score, and the bins kept apart on each side of 0
BINS, MAX_BIN = 64, 1024
CALIBRATION = 5
#: grams that may be broadcast (about 60 bytes each); beyond it only those with 1/HOT of all places, at most HOT of them
MAX_BROADCAST_GRAMS = 500_000
HOT = 10_000
_START, _END = "\u0002", "\u0003"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"\A[^/?#]*", 0)), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(set(rules), key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):  # the last one put on wins
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def read_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str, url_col: str) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict), held (kept for calibration)."""
    d = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    d = d.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    held = F.conv(F.substring(F.md5(F.col("url").cast("binary")), 1, 4), 16, 10).cast("int") % CALIBRATION == 0
    return d.select("*", rule.alias("rule"), verdict.alias("ruled"), held.alias("held"))


def grams(url: Column) -> Column:
    """Each character of the URL (lower-cased) and its end, after the ORDER characters before it."""
    letters = F.filter(F.split(lower_ascii(url), ""), lambda c: c != "")
    text = F.concat(F.array(*[F.lit(_START)] * ORDER), letters, F.array(F.lit(_END)))
    # a list of one text, so that the letters are listed once and not again for each gram
    cut = lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - ORDER - 1), lambda i: F.concat(*[F.get(t, i + k) for k in range(ORDER + 1)]))
    return F.get(F.transform(F.array(text), cut), 0)


def count_grams(urls: DataFrame) -> DataFrame:
    """(gram, n, a, r): places of each gram in all URLs, in accepted and in rejected examples."""
    example = lambda says: F.sum(F.when((F.col("ruled") == says) & ~F.col("held"), 1).otherwise(0))
    return urls.select("ruled", "held", F.explode(grams(F.col("url"))).alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), example("allow").alias("a"), example("block").alias("r"))


def log_ratios(counted: DataFrame) -> DataFrame:
    """(gram, n, term): ln P_accepted - ln P_rejected of each gram's last character, in whole millionths."""
    letter = F.col("gram").substr(ORDER + 1, 1)
    first = counted.groupBy(letter.alias("s")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    whole = first.agg(F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), F.count(F.lit(1)).alias("letters"))
    level = first.crossJoin(F.broadcast(whole)).select(  # one row of totals
        "s", *[((F.col(x) + 1) / (F.col(f"all_{x}") + F.col("letters"))).alias(f"p_{x}") for x in "ar"])
    for k in range(1, ORDER + 1):
        tail = F.col("gram").substr(ORDER + 1 - k, k + 1)
        found = counted.groupBy(tail.alias("t")).agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("r").alias("r"))
        same = Window.partitionBy(F.col("t").substr(1, k))  # the distinct characters after one context
        found = found.select("t", "n", "a", "r", F.col("t").substr(2, k).alias("s"),
                             *[F.sum(x).over(same).alias(f"all_{x}") for x in "ar"],
                             *[F.sum(F.when(F.col(x) > 0, 1).otherwise(0)).over(same).alias(f"seen_{x}") for x in "ar"])
        level = found.join(level.select("s", "p_a", "p_r"), "s").select(F.col("t").alias("s"), "n", *[
            F.when(F.col(f"all_{x}") > 0, (F.col(x) + F.col(f"seen_{x}") * F.col(f"p_{x}")) / (F.col(f"all_{x}") + F.col(f"seen_{x}")))
             .otherwise(F.col(f"p_{x}")).alias(f"p_{x}") for x in "ar"])
    term = F.round((F.log("p_a") - F.log("p_r")) * MILLION).cast("bigint")
    return level.select(F.col("s").alias("gram"), "n", term.alias("term"))


def look_up(places: DataFrame, ratios: DataFrame, max_broadcast: int) -> DataFrame:
    """``places`` with the term of each gram; grams of very many places never meet in one task."""
    terms = ratios.select("gram", "term")
    if ratios.count() <= max_broadcast:
        return places.join(F.broadcast(terms), "gram")
    total = ratios.agg(F.sum("n").alias("n")).first()["n"]
    hot = F.col("n") * HOT >= total  # so at most HOT grams
    often, rest = ratios.where(hot).select("gram", "term"), ratios.where(~hot).select("gram", "term")
    return places.join(F.broadcast(often), "gram").unionByName(
        places.join(F.broadcast(often.select("gram")), "gram", "left_anti").join(rest, "gram"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row ``least``: the lowest score bin that counts as accepted."""
    kept = scored.where("held AND ruled IS NOT NULL").groupBy("bin").agg(
        F.sum(F.when(F.col("ruled") == "allow", 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("bad"))
    zero = scored.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("good"), F.lit(0).cast("bigint").alias("bad"))
    bins = kept.unionByName(zero).groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))  # at most 2 * MAX_BIN + 1 rows
    upward = Window.orderBy(F.col("bin").desc())
    everything = Window.partitionBy()
    wide = "decimal(38,0)"
    margin = (F.sum("good").over(upward).cast(wide) * F.sum("bad").over(everything)
              - F.sum("bad").over(upward).cast(wide) * F.sum("good").over(everything)).cast(wide)
    return bins.select("bin", margin.alias("margin")).agg(
        F.min_by("bin", F.struct(-F.col("margin"), F.abs("bin"), "bin")).alias("least"))


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, id_col: str = "page_id", url_col: str = "url",
          max_broadcast: int = MAX_BROADCAST_GRAMS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (mean log ratio) and n_grams of every URL."""
    urls = read_urls(pages, RULES if rules is None else rules, id_col, url_col)
    counted = scratch_table(count_grams(urls), "url-grams")
    ratios = scratch_table(log_ratios(counted), "url-ratios")
    keyed = urls.select("*", F.monotonically_increasing_id().alias("row"))
    places = keyed.select("*", F.explode(grams(F.col("url"))).alias("gram"))
    keys = ["row", "page_id", "url", "host", "path", "rule", "ruled", "held"]
    summed = look_up(places, ratios, max_broadcast).groupBy(*keys).agg(F.sum("term").alias("total"), F.count(F.lit(1)).alias("n_grams"))
    score = F.col("total") / (F.col("n_grams") * MILLION)
    at = F.greatest(F.least(F.floor(score * BINS), F.lit(MAX_BIN)), F.lit(-MAX_BIN))
    scored = scratch_table(summed.select("page_id", "host", "path", "rule", "ruled", "held", "n_grams", score.alias("score"), at.alias("bin")), "url-scores")
    least = F.broadcast(threshold(scored))  # one row
    verdict = F.coalesce("ruled", F.when(F.col("bin") >= F.col("least"), "allow").otherwise("block"))
    return scored.crossJoin(least).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", "n_grams")


def keep_allowed(pages: DataFrame, rules: list[tuple[str, str]] | None = None, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with their own columns."""
    own = pages.columns
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    return judge(packed, rules).where("verdict = 'allow'").select("page_id.*")
