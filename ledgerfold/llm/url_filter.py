"""URL filter: rules first, then a ratio of character language models; DataFrame functions only.

The most specific (longest) of the rules that fit decides. A rule is `host/path`; it fits its
host and all subdomains if the url's path starts with the rule's path. URLs that a rule
allows or blocks train two character models over host and path. Each model is of variable
order: a character's chance after its last `order` characters is smoothed by the chance after
one character less (Witten-Bell: n + t in the denominator, t distinct followers), down to an
even chance. The difference of both log chances, summed over the url and divided by its number of
characters, is held against a threshold, which is the value that best separates the allowed
from the blocked urls: the cut with the largest sum of both hit rates (the lowest such cut), half
way between the mean scores on its two sides.

Defined cases: a null url, or one without `://`, has an empty host and path and is judged by
the chance of an empty url; without allowed or without blocked urls every undecided url is
allowed; repeated rows count each time and are returned each time.

Scale: urls are cut into grams of order + 1 characters once for counting (reduced map-side
to distinct grams, so what is kept grows with the urls' variety) and once for scoring, over
distinct urls. Lower orders are sums over the counted grams. Scores are whole millionths, so that
sums do not depend on the order of rows. The driver gets the threshold only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerfold.llm.store import stored

ORDER = 4
START, STOP = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(text: str, allow: bool) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, allow)


RULES = (rule("com/", True), rule("example.com/en/", False), rule("www.example.com/en/", True), rule("net/es/", False), rule("net/fr/", False))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)


def apply_rules(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls. Rules are a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.text)).otherwise(name), F.when(fits, F.lit(r.allow)).otherwise(verdict)
    return name, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """One row for each character of the url and one for its end: the character behind its context."""
    padded = F.concat(F.lit(START * order), "said", F.lit(STOP))
    cut = F.transform(F.sequence(F.lit(1), F.length("said") + 1), lambda i: F.substring(padded, i, F.lit(order + 1)))
    return urls.withColumn("gram", F.explode(cut))


def gram_scores(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, score: the difference of log chances in millionths, from said, n_allow, n_block."""
    sides = ("allow", "block")
    counts = stored(_grams(urls, order).groupBy("gram").agg(*(F.sum(f"n_{s}").alias(f"n_{s}") for s in sides)))
    size = counts.select(F.substring("gram", order + 1, 1).alias("c")).distinct().count()
    # Every gram stands under its last 1 to order + 1 characters; what precedes the last one is the context.
    tails = counts.withColumn("tail", F.explode(F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda k: F.substring("gram", -k, k))))
    context = F.substring("tail", 1, F.length("tail") - 1).alias("context")
    seen = tails.groupBy("tail").agg(*(F.sum(f"n_{s}").alias(f"n_{s}") for s in sides)).select("*", context)
    after = seen.groupBy("context").agg(*(F.sum(f"n_{s}").alias(f"all_{s}") for s in sides), *(F.sum((F.col(f"n_{s}") > 0).cast("long")).alias(f"kinds_{s}") for s in sides))
    known = seen.join(after, "context")
    steps = tails.select("gram", "tail").join(known, "tail").groupBy("gram").agg(F.array_sort(F.collect_list(
        F.struct(F.length("tail").alias("k"), *(f"{what}_{s}" for s in sides for what in ("n", "all", "kinds"))))).alias("steps"))

    def chance(side: str) -> Column:
        return F.aggregate("steps", F.lit(1.0 / max(size, 1)), lambda p, x: F.when(
            x[f"all_{side}"] > 0, (x[f"n_{side}"] + x[f"kinds_{side}"] * p) / (x[f"all_{side}"] + x[f"kinds_{side}"])).otherwise(p))

    return steps.select("gram", F.round((F.log(chance("allow")) - F.log(chance("block"))) * 1_000_000).cast("long").alias("score"))


def threshold(scored: DataFrame) -> int | None:
    """The mean score in thousandths, rounded down, that best separates both sides."""
    # Mean scores of urls lie within a few tens of nats: a bounded number of whole thousandths.
    step = F.floor(F.col("score") / (F.col("chars") * 1000)).cast("long")
    steps = scored.where("n_allow + n_block > 0").groupBy(step.alias("step")).agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
    both = steps.agg(F.sum("n_allow").alias("a"), F.sum("n_block").alias("b"), F.array_sort(F.collect_list(F.struct("step", "n_allow", "n_block"))).alias("steps"))
    # Blocked urls below a step, and allowed ones from it on.
    rates = lambda s: s.b / F.col("b") + (F.col("a") - s.a) / F.col("a")
    start = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(None).cast("long").alias("last"), F.lit(None).cast("long").alias("cut"), F.lit(-1.0).alias("best"))
    swept = F.aggregate("steps", start, lambda s, x: F.struct(
        (s.a + x.n_allow).alias("a"), (s.b + x.n_block).alias("b"), x.step.alias("last"),
        F.when(rates(s) > s.best, F.floor((F.coalesce(s.last, x.step) + x.step) / 2)).otherwise(s.cut).alias("cut"), F.greatest(s.best, rates(s)).alias("best")))
    row = both.where("a > 0 AND b > 0").select(swept.cut.alias("step")).first()
    return None if row is None else row["step"]


def judge(pages: DataFrame, *, rules: tuple[Rule, ...] = RULES, order: int = ORDER, id: str = "page_id", url: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, and the mean `score` in thousandths of a nat (null where a rule decides)."""
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(id), host.alias("host"), path.alias("path"))
    name, allow = apply_rules(F.col("host"), F.col("path"), rules)
    ruled = parts.select(id, "host", "path", name.alias("rule"), allow.alias("allow"))
    # What a model is told or asked about: each distinct host and path once, with its number of rows.
    urls = stored(ruled.groupBy(F.concat("host", "path").alias("said")).agg(
        F.sum(F.coalesce(F.col("allow").cast("long"), F.lit(0))).alias("n_allow"), F.sum(F.coalesce((~F.col("allow")).cast("long"), F.lit(0))).alias("n_block")))
    scores = stored(gram_scores(urls, order))
    scored = stored(_grams(urls, order).join(scores, "gram").groupBy("said", "n_allow", "n_block").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("chars")))
    least = threshold(scored)
    mean = F.floor(F.col("score") / (F.col("chars") * 1000)).cast("long")
    said = F.lit(True) if least is None else F.coalesce(mean >= least, F.lit(True))
    judged = ruled.withColumn("said", F.concat("host", "path")).join(scored.select("said", "score", "chars"), "said", "left")
    verdict = F.when(F.coalesce("allow", said), F.lit("allow")).otherwise(F.lit("block"))
    return judged.select(id, "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("allow").isNull(), mean).alias("score"))
