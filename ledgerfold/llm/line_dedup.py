"""Line dedup over fuzzy lines, in DataFrame functions only.

Lines (split at \\n) are normalised: lower case, words between blanks without `PUNCTUATION` at
their ends, one blank between. Lines of `min_words` words or more take part. Two lines are linked when
their edit similarity, 1 - edits / length of the longer, is `percent` % or more. Of all
occurrences of the lines in one connected group, the first (smallest document id, then line)
stays, the others are removed.

Candidates (`distance=None`, as in the query and the pipeline) are lines that meet under one of `BANDS`
keys, each made of `ROWS` out of `HASHES` weighted min-hashes of the words. A word that stands in n places
weighs about 1 / sqrt(n), so that lines meet by the rare words they share; a word that stands
nowhere else cannot be shared and weighs little. This finds pairs by chance: nearly all that differ in whole
words, fewer of those whose edits are spread over most words (shares in the README). With a `distance` (2 bits
at most) lines are linked only if besides their 64-bit SimHashes of words differ in so many bits at most: with four
blocks of 16 bits, two differing bits leave two blocks alone at least, and lines meet under
each of the six pairs of blocks (32-bit keys). Under each key all lines are held against the
smallest one first, which costs one comparison a line; links found there join most groups. Keys
that still hold several components are then joined in full, in blocks of `BLOCK` lines, so no pair that meets is
lost and no task holds a whole key.

Defined cases: null text stays null and has no lines; rows equal in id and text count as one
document, so their lines stay or go together; rows that share an id but not the text are
ordered by a hash of the text; a null id sorts first; lines with fewer words always stay; an
empty table gives no rows.

Scale: words are counted into min-hashes or SimHashes where they are read (minima, or sums in lanes of a few
longs), their weights come from a table of fixed size, so only hashes and places of lines are shuffled, distinct lines once for each key; texts of
candidate lines are fetched once, picked by a bitmap of fixed size. Equal lines fold into one
before anything is joined. Documents are shuffled once, to meet their lists of lines to remove;
those lists hang on unique keys, so a hot line's join can be split."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, functions as F

from ledgerfold.llm.components import components
from ledgerfold.llm.store import fresh, spread, stored

MIN_WORDS = 5
DISTANCE = 2
PERCENT = 80
BLOCKS, BLOCK_BITS = 4, 16
#: Four lanes of 16 bits in one long, and the words that are counted in lanes at once.
LANES, LANE_WORDS = 0x0001000100010001, 0x3FFF
FILTER_WORDS = 1 << 16
#: Lines of a key that are compared in one group at most, on either side.
BLOCK = 1024
#: Keys of a line that are shuffled together; their shuffle leaves the disk before that of the next.
KEYS_AT_ONCE = 6
#: Min-hashes of a line, how many make a key, and the keys: three ways to deal the hashes out.
HASHES, ROWS = 24, 4
BANDS = [[ROWS * j + t for t in range(ROWS)] for j in range(HASHES // ROWS)] + [[HASHES // ROWS * t + (j + s * t) % (HASHES // ROWS) for t in range(ROWS)] for s in (0, 1) for j in range(HASHES // ROWS)]
#: Weights of words are 2 ** -level, one of four bits for each cell of words; the level of a word that stands alone.
LEVELS, ALONE = 16, 6
#: What is cut off both ends of a word.
PUNCTUATION = ".,;:!?\"'()"
#: What stands between words, a carriage return before the end of a line too.
BLANKS = r"[\x20\x09-\x0D]+"
#: Similar lines are held against each other in pieces of so many characters, cut where so many stand in both, so far from where they are awaited at most.
PIECE, ANCHOR, SHIFT = 32, 10, 24


def _counted() -> list[Column]:
    """Aggregates over word hashes v: how many have each bit. Lane j of counter i counts bit 16 j + i."""
    return [F.sum(F.shiftrightunsigned("v", i).bitwiseAND(F.lit(LANES))).alias(f"c{i}") for i in range(16)]


def _majority(n: Column) -> Column:
    """The bits that more than half of n counted hashes have; n is LANE_WORDS at most."""
    # A lane reaches bit 14 if it counts more than half.
    lift = (F.lit(LANE_WORDS).cast("long") - F.floor(n / 2).cast("long")) * F.lit(LANES)
    out = None
    for i in range(16):
        part = F.shiftleft(F.shiftrightunsigned(F.col(f"c{i}") + lift, 14).bitwiseAND(F.lit(LANES)), i)
        out = part if out is None else out.bitwiseOR(part)
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """doc, digest, line, said, k: every line in lower case, and one number for its place."""
    each = docs.select("doc", "digest", F.posexplode(F.split(F.lower("text"), "\n")).alias("line", "said"))
    return each.withColumn("k", F.xxhash64("doc", "digest", "line"))


def _cut(line: str) -> Column:
    """The parts of a line between blanks, empty ones too; by the pattern only where there are other blanks than spaces."""
    odd = reduce(Column.__or__, (F.contains(F.col(line), F.lit(b)) for b in "\t\x0b\x0c\r"))
    return F.when(odd, F.split(line, BLANKS)).otherwise(F.split(line, " "))


def _trimmed(word: Column) -> Column:
    """Most words have no punctuation at their ends and need no search for it."""
    marked = reduce(Column.__or__, (F.endswith(word, F.lit(p)) | F.startswith(word, F.lit(p)) for p in PUNCTUATION))
    return F.when(marked, F.btrim(word, F.lit(PUNCTUATION))).otherwise(word)


def line_hashes(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, digest, line, k, h (of the line in lower case) and sig (SimHash of its words) of all lines that
    take part.

    Lines longer than the lanes can count are cut into parts, whose SimHashes are counted in turn."""
    place = ["doc", "digest", "line", "h"]
    split = _lines(docs).select("k", "doc", "digest", "line", F.xxhash64("said").alias("h"), _cut("said").alias("words"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / LANE_WORDS).cast("int")), lambda i: F.slice("words", i * LANE_WORDS + 1, F.lit(LANE_WORDS)))
    parted = split.select("k", *place, F.posexplode(F.when(F.size("words") <= LANE_WORDS, F.array("words")).otherwise(cut)).alias("part", "words"))
    words = parted.select("k", "part", *place, F.explode("words").alias("word")).select("k", "part", *place, F.btrim("word", F.lit(PUNCTUATION)).alias("word")).where("word != ''")
    parts = words.withColumn("v", F.xxhash64("word")).groupBy("k", "part", *place).agg(F.count(F.lit(1)).alias("n"), *_counted())
    parts = parts.select("k", "n", *place, _majority(F.col("n")).alias("v"))
    whole = parts.groupBy("k", *place).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), *_counted())
    return whole.where(F.col("n") >= min_words).select("doc", "digest", "line", "k", "h", _majority(F.col("parts")).alias("sig"))


def _dense(cells: DataFrame) -> DataFrame:
    """cell and bits as one value, an array of `FILTER_WORDS` longs."""
    full = cells.sparkSession.range(FILTER_WORDS).join(cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")), F.col("id") == F.col("cell"), "left")
    return stored(full.select(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("c")).agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.bits).alias("bitmap")))


def _level(v: Column) -> tuple[Column, Column]:
    """Of a word's hash: which long holds its level, and at which bit."""
    cell = F.pmod(v, F.lit(LEVELS * FILTER_WORDS))
    return F.shiftrightunsigned(cell, 4), F.shiftleft(cell.bitwiseAND(F.lit(LEVELS - 1)), 2).cast("int")


def line_keys(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, digest, line, h as in `line_hashes`, chars (of the normalised line) and keys of all lines that take part."""
    place = ["doc", "digest", "line", "h"]
    split = _lines(docs).select("doc", "digest", "line", F.xxhash64("said").alias("h"), F.explode(_cut("said")).alias("word"))
    words = split.withColumn("word", _trimmed(F.col("word"))).where("word != ''").select(*place, F.length("word").alias("size"), F.xxhash64("word").alias("v"))
    at, bit = _level(F.col("v"))
    counted = words.select(at.alias("cell"), bit.alias("bit")).groupBy("cell", "bit").agg(F.count(F.lit(1)).alias("n"))
    level = F.when(F.col("n") == 1, ALONE).otherwise(F.least(F.floor(F.log2("n") / 2), F.lit(LEVELS - 1))).cast("long")
    levels = _dense(counted.select("cell", F.call_function("shiftleft", level, F.col("bit")).alias("bits")))
    weighed = words.withColumn("level", F.call_function("shiftrightunsigned", F.get(levels.scalar(), at.cast("int")), bit).bitwiseAND(F.lit(LEVELS - 1).cast("long")).cast("int"))
    # 44 bits of a hash, made larger the less the word weighs.
    least = [F.min(F.call_function("shiftleft", F.shiftrightunsigned(F.xxhash64("v", F.lit(i)), 20), F.col("level"))).alias(f"m{i}") for i in range(HASHES)]
    lines = weighed.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars"), *least).where(F.col("n") >= min_words)
    keys = F.array(*(F.hash(*(f"m{i}" for i in band)) for band in BANDS))
    return lines.select(*place, (F.col("chars") + F.col("n") - 1).alias("chars"), keys.alias("keys"))


def normalised(line: Column) -> Column:
    """The words of a line in lower case, one blank between."""
    return F.array_join(F.filter(F.transform(F.split(line, BLANKS), lambda w: F.btrim(w, F.lit(PUNCTUATION))), lambda w: w != ""), " ")


def _keys(sig: Column) -> Column:
    """Every pair of blocks as a number: which pair, and the bits of both."""
    block = [F.shiftrightunsigned(sig, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for i in range(BLOCKS)]
    return F.array(*(F.shiftleft(F.lit(k).cast("long"), 2 * BLOCK_BITS).bitwiseOR(F.shiftleft(block[a], BLOCK_BITS)).bitwiseOR(block[b]) for k, (a, b) in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE))))


def _shared(classes: DataFrame, keys: Column, n: int) -> DataFrame:
    """key, h, mark, lead (h and mark of the smallest line) of all keys that several lines have. Of the n keys of a line, `KEYS_AT_ONCE` are
    shuffled together."""
    parts = []
    for at in range(0, n, KEYS_AT_ONCE):
        keyed = classes.select(F.explode(F.slice(keys, at + 1, KEYS_AT_ONCE)).alias("key"), "h", "mark")
        # Of plain numbers, so that no rows are sorted for it.
        leads = keyed.groupBy("key").agg(F.min("h").alias("low"), F.min_by("mark", "h").alias("low_mark"), F.max("h").alias("last")).where("low < last")
        lead = F.struct(F.col("low").alias("h"), F.col("low_mark").alias("mark")).alias("lead")
        parts.append(stored(keyed.join(leads, "key").select("key", "h", "mark", lead)))
    return reduce(DataFrame.unionByName, parts)


def _pairs(placed: DataFrame, close) -> DataFrame:
    """Of rows key, h, mark, component: all close pairs a, b under a key that holds several components, where these differ.

    Lines of a key are dealt to blocks, and each two blocks are joined as a group of their own."""
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).where("low < high").select("key", "blocks")
    dealt = stored(placed.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("h"), "blocks").cast("int")))
    one = dealt.select("key", "h", "mark", "component", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j")).alias("x")
    two = dealt.select("key", "h", "mark", "component", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j")).alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    once = (F.col("x.i") < F.col("x.j")) | (F.col("x.h") < F.col("y.h"))
    both = one.join(two, same & once & (F.col("x.component") != F.col("y.component")) & close(F.col("x.mark"), F.col("y.mark")))
    return both.select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b")).distinct()


def _texts(ends: DataFrame, docs: DataFrame, places: DataFrame) -> DataFrame:
    """h and the normalised text (said) of the wanted lines. places: h and where the line first stands (doc, digest, line)."""
    wanted = stored(places.join(ends, "h", "left_semi").select("h", "doc", "digest", "line", F.xxhash64("doc", "digest", "line").alias("k")))
    # A bitmap of fixed size over the wanted places, as one value.
    cell, bit = F.shiftrightunsigned(F.pmod("k", F.lit(64 * FILTER_WORDS)), 6), F.pmod("k", F.lit(64)).cast("int")
    cells = wanted.select(cell.alias("cell"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    bitmap = _dense(cells)
    near = _lines(docs).where(F.call_function("shiftrightunsigned", F.get(bitmap.scalar(), cell.cast("int")), bit).bitwiseAND(F.lit(1).cast("long")) == 1)
    same = near["doc"].eqNullSafe(wanted["doc"]) & (near["digest"] == wanted["digest"]) & (near["line"] == wanted["line"]) & (near["k"] == wanted["k"])
    return stored(near.join(wanted, same).groupBy("h").agg(F.min("said").alias("said")).select("h", normalised(F.col("said")).alias("said")))


def _left(a: Column, b: Column, allowed: Column) -> Column:
    """The allowed edits less those of the pieces that both texts are cut into, negative if there are more: edits of pieces make up
    edits of the whole, so no pair is let through wrongly, but some that are near enough can fail here."""
    at = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), allowed.alias("left"))

    def less(now, to_a, to_b):
        edits = F.call_function("levenshtein", F.substring(a, now.a + 1, to_a - now.a), F.substring(b, now.b + 1, to_b - now.b), now.left)
        # Beyond what is left it is -1, which makes a large number here.
        return F.when(now.left < 0, now.left).otherwise(now.left - F.pmod(edits, F.lit(1 << 30)))

    def cut(now, to):
        begin = now.b + to - now.a - SHIFT
        found = F.instr(F.substring(b, begin + 1, F.lit(2 * SHIFT + ANCHOR)), F.substring(a, to + 1, F.lit(ANCHOR)))
        moved = F.transform(F.array(found), lambda x: F.when(x > 0, F.struct(to.alias("a"), (begin + x - 1).alias("b"), less(now, to, begin + x - 1).alias("left"))))
        return F.when(now.left < 0, now).otherwise(F.coalesce(F.get(moved, F.lit(0)), now))

    steps = F.when(F.length(a) > PIECE + ANCHOR, F.sequence(F.lit(PIECE), F.length(a) - ANCHOR, F.lit(PIECE))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, at, cut, lambda now: less(now, F.length(a), F.length(b)))


def _similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those stored pairs of lines (their hashes a, b) whose normalised texts are similar."""
    if pairs.isEmpty():
        return pairs
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("said").alias("said_a")), "a").join(texts.select(F.col("h").alias("b"), F.col("said").alias("said_b")), "b")
    longer = F.greatest(F.length("said_a"), F.length("said_b"))
    allowed = F.floor(longer * (100 - percent) / 100).cast("int")
    both = both.withColumn("allowed", allowed).where(F.abs(F.length("said_a") - F.length("said_b")) <= F.col("allowed"))
    # Most pairs are similar piece by piece, which costs time by their length, not its square; only the others need the whole table.
    return both.where((_left(F.col("said_a"), F.col("said_b"), F.col("allowed")) >= 0) | F.expr("levenshtein(said_a, said_b, allowed) >= 0")).select("a", "b")


def _alike(pairs: DataFrame, docs: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """`_similar`, with the texts of these pairs alone."""
    pairs = stored(pairs)
    ends = pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))).distinct()
    return _similar(pairs, _texts(ends, docs, places), percent)


def _joined(member: DataFrame, more: DataFrame) -> DataFrame:
    """h and component once links a, b join some of the components; as each is named by its smallest line, so is what they make."""
    for end in ("a", "b"):
        more = more.join(member.select(F.col("h").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    larger = stored(components(more))
    within = member.join(larger.withColumnRenamed("component", "whole"), F.col("component") == F.col("vertex"), "left").select("h", F.coalesce("whole", "component").alias("component"))
    alone = larger.select(F.col("vertex").alias("h"), "component").join(member, "h", "left_anti")
    return stored(within.unionByName(alone))


def _named(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))


def lines_to_remove(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, distance: int | None = DISTANCE) -> DataFrame:
    """doc, digest and the sorted numbers of the `lines` that go, for documents that lose any."""
    source = _named(docs, id, text)
    place = F.struct("doc", "digest", "line")
    if distance is None:
        lines = stored(line_keys(source, min_words))
        close = lambda x, y: F.abs(x - y) <= F.floor(F.greatest(x, y) * (100 - percent) / 100)
        mark, keys = "chars", F.transform("keys", lambda key, i: F.shiftleft(i.cast("long"), 32).bitwiseOR(key.cast("long").bitwiseAND(F.lit((1 << 32) - 1))))
    else:
        lines = stored(line_hashes(source, min_words))
        close = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= distance
        mark, keys = "sig", _keys(F.col("mark"))
    # Of equal lines, one stands for all: their marks and keys are the same.
    lines = lines.withColumnRenamed(mark, "mark")
    one = [F.min("mark").alias("mark"), *([F.min("keys").alias("keys")] if distance is None else [])]
    classes = stored(lines.groupBy("h").agg(*one, F.min(place).alias("first"), F.max(place).alias("last")))
    places = classes.select("h", "first.*")
    shared = _shared(classes, keys, len(BANDS) if distance is None else comb(BLOCKS, DISTANCE))
    stars = shared.where((F.col("h") != F.col("lead.h")) & close(F.col("mark"), F.col("lead.mark"))).select(F.col("lead.h").alias("a"), F.col("h").alias("b")).distinct()
    # All lines that meet another one under a key: both steps take their texts from here.
    texts = _texts(shared.select("h").distinct(), source, places)
    stars = stored(stars)
    with spread(docs.sparkSession):
        links = stored(_similar(stars, texts, percent))
    member = stored(components(links).select(F.col("vertex").alias("h"), "component"))
    # Keys that hold several components: all close pairs that no path joins yet.
    placed = shared.select("key", "h", "mark").join(member, "h", "left").withColumn("component", F.coalesce("component", "h"))
    # The first step has held some of them against each other already.
    rest = stored(_pairs(placed, close).join(stars, ["a", "b"], "left_anti"))
    with spread(docs.sparkSession):
        more = stored(_similar(rest, texts, percent))
    member = _joined(member, more)
    # The first place of every group; a group of one line in one place removes nothing.
    groups = classes.join(member, "h", "left").where("component is not null or first < last").select("h", "first", "last", F.coalesce("component", "h").alias("component"))
    first = groups.groupBy("component").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last").select("component", "first")
    keep = groups.select("h", "component").join(first, "component").select("h", "first")
    gone = lines.join(keep, "h").where(place != F.col("first"))
    return gone.groupBy("doc", "digest").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def dedup_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT, distance: int | None = DISTANCE, removed: str | None = None) -> DataFrame:
    """The documents with only the remaining lines in their text; `removed` names a column for the numbers of those that went."""
    gone = lines_to_remove(docs, id=id, text=text, min_words=min_words, percent=percent, distance=distance)
    digest, doc_r, digest_r, lines = fresh(docs, "digest", "doc_r", "digest_r", "lines")
    lists = gone.select(F.col("doc").alias(doc_r), F.col("digest").alias(digest_r), F.col("lines").alias(lines))
    both = docs.withColumn(digest, F.xxhash64(text)).join(lists, F.col(id).eqNullSafe(F.col(doc_r)) & (F.col(digest) == F.col(digest_r)), "left")
    split = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), lines)
    kept = F.when(F.col(lines).isNull(), F.col(text)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n"))
    columns = [kept.alias(c) if c == text else F.col(c) for c in docs.columns]
    return both.select(*columns, *([F.coalesce(lines, F.array().cast("array<int>")).alias(removed)] if removed else []))


def digest(docs: DataFrame) -> DataFrame:
    """Counts and a digest of what stays, for each document."""
    gone = dedup_lines(docs.select("doc_id", "text"), distance=None, removed="gone")
    return gone.select("doc_id", (F.size(F.split(F.coalesce("text", F.lit("")), "\n")) + F.when(F.size("gone") > 0, F.size("gone")).otherwise(0)).cast("long").alias("n_lines"),
                       F.size("gone").cast("long").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
