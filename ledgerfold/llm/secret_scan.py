"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Base kinds are found by pattern, leftmost and not overlapping within a kind, and always
reported. Generic candidates (long runs of token characters that mix lower case, upper
case and digits) are reported as kind `live` only if ownership says so: the hash of
each found value is counted by distinct repositories and distinct owners. A value that at
most `max_owners` owners have, in `max_repositories` repositories at most, looks like a credential
in use; one of `example_owners` owners or more is a copied example; what lies between is shared,
also a value that one owner repeats all over its repositories. A generic candidate must not
overlap a base span of its text.

Spans are kind:start:end in code points, end exclusive, and cover the whole match; the value
of an assignment is its second part.

Defined cases: null text is empty; a null owner or repository is one of its own kind; one row
goes out for each row that comes in, repeated ones included; only the named columns are read.

Scale: texts are scanned once and not shuffled; the matches are written, and only hashes
and places are counted, ranked and joined. Hashes are made distinct by owner and by
repository before they are counted, so a value copied everywhere stays cheap; the join is to
one row a hash. Places come from running sums over the pieces between marks, by text and kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerfold.llm.store import stored

#: The kinds in their order, each as a pattern of two groups, and the least length of the second one.
KINDS = (
    ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 12),
    ("access", r"()(AKIA[A-Z0-9]+)", 18),
    ("hex", r"()([0-9a-f]{16,})", 16),
)
GENERIC = r"()([A-Za-z0-9+/_=-]{24,})"
MAX_OWNERS, EXAMPLE_OWNERS, MAX_REPOSITORIES = 1, 3, 10
#: Marks around matches. In a text they stand for nothing that a pattern matches, and are replaced by a third one first.
BEGIN, END, PART, OTHER = "\x01", "\x02", "\x04", "\x05"


def _pieces(text: Column, kind: int, pattern: str, hashed: bool = True) -> Column:
    """An array of pieces: number, characters before the value, of the value and behind the match, and the value's hash.
    Empty if nothing matches."""
    marked = F.regexp_replace(text, pattern, f"{BEGIN}$1{PART}$2{END}")
    parts = F.split(marked, BEGIN)

    def piece(part: Column, i: Column) -> Column:
        body = F.substring_index(part, END, 1)
        value = F.substring_index(body, PART, -1)
        rest = F.when(i == 0, F.length(part)).otherwise(F.length(part) - F.length(body) - 1)
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.when(i == 0, 0).otherwise(F.length(body) - F.length(value) - 1).alias("head"),
                        F.when(i == 0, 0).otherwise(F.length(value)).alias("size"), rest.alias("rest"),
                        F.when(i > 0, F.sha2(value, 256)).alias("hash"),
                        ((i > 0) & F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[a-z]")) & F.rlike(value, F.lit("[A-Z]"))).alias("mixed"))

    pieces = F.transform(parts, piece)
    return F.when(F.size(parts) > 1, pieces).otherwise(F.slice(pieces, 1, 0))


def find_candidates(docs: DataFrame, *, text: str = "text", id: str = "doc_id", repository: str = "doc_id", owner: str = "source") -> tuple[DataFrame, DataFrame]:
    """All rows (row, doc) and their candidates (row, repository, owner, kind, start, end, hash)."""
    clean = F.translate(F.coalesce(text, F.lit("")), BEGIN + END + PART, OTHER * 3)
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("doc"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
                        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), clean.alias("text"))
    kinds = [*(p for _, p, _ in KINDS), GENERIC]
    pieces = stored(named.select("row", "doc", "repository", "owner", F.concat(*(_pieces(F.col("text"), k, p) for k, p in enumerate(kinds))).alias("pieces")))
    each = pieces.where(F.size("pieces") > 0).select("row", "repository", "owner", F.explode("pieces").alias("p")).select("row", "repository", "owner", "p.*")
    before = F.sum(F.col("head") + F.col("size") + F.col("rest")).over(Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    placed = each.withColumn("start", before).withColumn("end", F.col("start") + F.col("head") + F.col("size")).where("i > 0")
    least = F.element_at(F.array(*(F.lit(n) for *_, n in KINDS), F.lit(0)), F.col("kind") + 1)
    good = (F.col("size") >= least) & ((F.col("kind") < len(KINDS)) | F.col("mixed"))
    return pieces.select("row", "doc"), placed.where(good).select("row", "repository", "owner", "kind", "start", "end", "hash")


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories."""
    owners = candidates.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))
    repositories = candidates.select("hash", "repository").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_repositories"))
    return owners.join(repositories, "hash")


def scan(docs: DataFrame, *, max_owners: int = MAX_OWNERS, example_owners: int = EXAMPLE_OWNERS, max_repositories: int = MAX_REPOSITORIES, text: str = "text", id: str = "doc_id",
         repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row for each document: its id and `spans`, an array of kind, start, end, hash, n_owners, n_repositories, standing."""
    rows, candidates = find_candidates(docs, text=text, id=id, repository=repository, owner=owner)
    candidates = stored(candidates)
    standing = F.when((F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories), "live").when(F.col("n_owners") >= example_owners, "example").otherwise("shared")
    counted = candidates.join(ownership(candidates), "hash").withColumn("standing", standing)
    span = F.struct("start", "kind", "end", "hash", "n_owners", "n_repositories", "standing")
    base, generic = F.col("kind") < len(KINDS), (F.col("kind") == len(KINDS)) & (F.col("standing") == "live")
    grouped = counted.where(base | generic).groupBy("row").agg(F.array_sort(F.collect_list(F.when(base, span))).alias("base"), F.collect_list(F.when(generic, span)).alias("generic"))
    free = F.filter("generic", lambda g: ~F.exists("base", lambda b: (b.start < g.end) & (g.start < b.end)))
    spans = grouped.select(F.col("row").alias("at"), F.array_sort(F.concat("base", free)).alias("spans"))
    names = F.array(*(F.lit(n) for n, *_ in KINDS), F.lit("live"))
    return rows.join(spans, rows["row"] == spans["at"], "left").select(F.col("doc").alias(id), F.transform(F.coalesce("spans", F.array()), lambda s: F.struct(
        F.element_at(names, s.kind + 1).alias("kind"), s.start.alias("start"), s.end.alias("end"), s.hash.alias("hash"), s.n_owners.alias("n_owners"),
        s.n_repositories.alias("n_repositories"), s.standing.alias("standing"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    line = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    base = F.transform(F.filter("spans", lambda s: s.kind != "live"), line)
    return found.select("doc_id", *(number(k).alias(f"n_{k}") for k, *_ in KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", line), ",").alias("spans"), number("live").alias("n_live"),
                        F.size(F.filter("spans", lambda s: (s.kind != "live") & (s.standing == "example"))).cast("long").alias("n_example"))
