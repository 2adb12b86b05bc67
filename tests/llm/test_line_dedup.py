import random
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerfold.llm import line_dedup
from ledgerfold.llm.line_dedup import LANE_WORDS, PUNCTUATION, dedup_lines, line_hashes
from tests.llm.cases import documents, odd_rows, sentence


def worded(line):
    return [x for w in line.split(" ") if (x := w.strip(PUNCTUATION))]


def majority(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) - len(hashes) % 2)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def family(seed):
    rng = random.Random(seed)
    rows = odd_rows(seed)
    for k in range(4):
        words = sentence(rng, 60).split(" ")
        for copy in range(6):
            rows.append((200 + 10 * k + copy, sentence(rng, 12) + "\n" + " ".join(words).capitalize() + ".\n" + ", ".join(words)))
            words[rng.randrange(60)] += "x"
    return rows


def test_removed_lines_against_brute_force(spark):
    rows = family(5)
    docs = documents(spark, rows)
    lines = defaultdict(list)
    digests = {r.text: r.d for r in docs.select("text", F.xxhash64("text").alias("d")).collect()}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            if len(worded(line.lower())) >= 5:
                lines[line.lower()].append((i is not None, i or 0, digests[t], n))
    every = sorted({w for s in lines for w in worded(s)})
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for w in every], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    sims = {s: majority([hashes[w] for w in worded(s)]) for s in lines}
    text = {s: " ".join(worded(s)) for s in lines}
    group = {s: s for s in lines}
    def root(s):
        while group[s] != s:
            s = group[s]
        return s
    said = sorted(lines)
    links = 0
    for x, a in enumerate(said):
        for b in said[:x]:
            if (sims[a] ^ sims[b]).bit_count() <= 2 and edits(text[a], text[b]) <= max(len(text[a]), len(text[b])) * 20 // 100:
                group[root(a)] = root(b)
                links += 1
    places = defaultdict(set)
    for s, p in lines.items():
        places[root(s)].update(p)
    gone = {p for group_places in places.values() for p in group_places if p != min(group_places)}
    want = []
    for i, t in rows:
        drop = [n for n in range(len((t or "").split("\n"))) if (i is not None, i or 0, digests[t], n) in gone]
        want.append((i, t if not drop else "\n".join(line for n, line in enumerate(t.split("\n")) if n not in drop), drop))
    got = [(r.doc_id, r.text, r.gone) for r in dedup_lines(docs, removed="gone").collect()]
    assert links > 3 and sorted(got, key=repr) == sorted(want, key=repr)


def test_simhash_of_lines_longer_than_the_counters(spark):
    n = LANE_WORDS + 7
    words = [f"w{k}" for k in range(n)]
    row = line_hashes(spark.createDataFrame([(1, 2, " ".join(words))], "doc long, digest long, text string"), 5).first()
    hashes = [r.h for r in spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string").orderBy("k").select(F.xxhash64("w").alias("h")).collect()]
    assert row.sig & (1 << 64) - 1 == majority([majority(hashes[:LANE_WORDS]), majority(hashes[LANE_WORDS:])])


def test_line_ends_and_tabs_stand_between_words(spark):
    said = "Some words, of a line that stands twice."
    rows = [(1, said + "\nx"), (2, said + "\r\nx\r"), (3, said.replace(" ", "\t")), (4, "\x0b" + said.replace(" ", " \x0c "))]
    docs = documents(spark, rows)
    hashed = line_hashes(docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("digest"), "text"), 5).collect()
    assert sorted(r.doc for r in hashed) == [1, 2, 3, 4] and len({r.sig for r in hashed}) == 1
    got = {r.doc_id: r.gone for r in dedup_lines(docs, distance=None, removed="gone").collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: [0]}


def test_a_key_is_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(3)
    placed = [(key, h, 10 + h % 3, h % 4) for key in range(3) for h in rng.sample(range(100), 20)] + [(9, h, 10, 7) for h in range(5)]
    frame = spark.createDataFrame(placed, "key long, h long, mark long, component long")
    want = {(a, b) for k, a, m, c in placed for x, b, n, d in placed if k == x and a < b and c != d and abs(m - n) <= 1}
    for block in (4, 1024):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        assert {tuple(r) for r in line_dedup._pairs(frame, lambda x, y: F.abs(x - y) <= 1).collect()} == want


def test_keys_of_a_line_are_shuffled_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    frame = spark.createDataFrame([(h, h % 5, [100 * i + rng.randrange(12) for i in range(7)]) for h in rng.sample(range(-500, 500), 30)], "h long, mark int, keys array<long>")
    lines = defaultdict(list)
    for r in frame.collect():
        for key in r["keys"]:
            lines[key].append((r.h, r.mark))
    want = sorted((key, h, mark, min(own)) for key, own in lines.items() if len(own) > 1 for h, mark in own)
    sizes, write = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df: sizes.append(df.count()) or write(df))
    for at_once, writes in ((3, 3), (7, 1)):
        monkeypatch.setattr(line_dedup, "KEYS_AT_ONCE", at_once)
        sizes.clear()
        assert sorted((r.key, r.h, r.mark, tuple(r.lead)) for r in line_dedup._shared(frame, F.col("keys"), 7).collect()) == want
        assert len(sizes) == writes and sum(sizes) == len(want)


def test_pairs_at_the_edge_of_both_bands(spark):
    rng = random.Random(9)
    said = (sentence(rng, 100)[:199] + "x").lower()
    rows = [(0, said)] + [(n, said[:-n] + "#" * n) for n in (1, 4, 5, 6, 39, 40, 41, 60)]
    docs = documents(spark, rows).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("digest"), "text")
    place = {r.doc: r for r in docs.select("*", F.xxhash64(F.lower("text")).alias("h")).collect()}
    places = docs.select(F.xxhash64(F.lower("text")).alias("h"), "doc", "digest", F.lit(0).alias("line"))
    pairs = spark.createDataFrame([(place[0].h, place[n].h) for n, _ in rows[1:]], "a long, b long")
    text = {n: " ".join(worded(t.lower())) for n, t in rows}
    want = {place[n].h for n, _ in rows[1:] if edits(text[0], text[n]) <= max(len(text[0]), len(text[n])) * 20 // 100}
    assert 0 < len(want) < 8 and {r.b for r in line_dedup._alike(pairs, docs, places, 80).collect()} == want


def test_no_window_over_a_key(spark, monkeypatch):
    plans, write = [], line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    rows = [(k, "the same words in every line here " + str(k % 2)) for k in range(6)]
    assert line_dedup.lines_to_remove(documents(spark, rows), distance=None).count() >= 4
    assert plans and not any("Window" in p for p in plans)


def test_empty_table_and_columns(spark):
    none = documents(spark, [])
    assert dedup_lines(none).columns == none.columns and dedup_lines(none).collect() == []


def test_pairs_are_found_by_edit_similarity_alone(spark):
    rng = random.Random(8)
    words = [sentence(rng, 1) + sentence(rng, 1) for _ in range(3000)]
    rows = []
    for k in range(120):
        line = [rng.choice(words) for _ in range(rng.choice([6, 10, 20, 40]))]
        copy, left = line.copy(), len(" ".join(line)) // 6
        for at in rng.sample(range(len(line)), len(line)):
            # A word of as many other letters.
            if len(copy[at]) > left:
                break
            left -= len(copy[at])
            copy[at] = "".join(rng.choice("fghij") for _ in copy[at])
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(copy))]
    text = {i: t for i, t in rows}
    similar = lambda a, b: edits(a, b) <= max(len(a), len(b)) * 20 // 100
    pairs = [(k, k + 1) for k in range(0, 240, 2) if text[k] != text[k + 1] and similar(text[k], text[k + 1])]
    gone = {r.doc_id for r in dedup_lines(documents(spark, rows), distance=None, removed="gone").where("size(gone) > 0").collect()}
    assert len(pairs) > 80 and sum(b in gone for _, b in pairs) >= 0.95 * len(pairs)
    assert gone <= {b for _, b in pairs} | {k + 1 for k in range(0, 240, 2) if text[k] == text[k + 1]}


def test_pieces_bound_the_edits(spark):
    rng = random.Random(12)
    rows = []
    for size in (0, 3, 30, 40, 90, 400, 1500):
        for share in (0, 0.02, 0.08, 0.15, 0.3):
            said = [rng.choice("abcdeé \U0001f600") for _ in range(size)]
            copy = [rng.choice(["", "x", c + "y"]) if rng.random() < share else c for c in said]
            rows.append(("".join(said), "".join(copy), size // 5))
    rows += [("the same passage of words " * 40, "the same passage of words " * n, 250) for n in (1, 31, 39, 44)] + [("a" * 300, "b" * 300, 60), ("", "b" * 50, 10)]
    frame = spark.createDataFrame(rows, "a string, b string, allowed int")
    got = frame.select("*", line_dedup._left(F.col("a"), F.col("b"), F.col("allowed")).alias("left")).collect()
    within = [r for r in got if edits(r.a, r.b) <= r.allowed]
    assert all(r["left"] < 0 or r.allowed - r["left"] >= edits(r.a, r.b) for r in got)
    assert 10 < len(within) < len(got) and sum(r["left"] >= 0 for r in within) >= 0.8 * len(within)


def test_only_other_pairs_need_the_whole_table(spark, monkeypatch):
    # Edits at the start and at the end, in lines too long for a table of all their characters.
    rng = random.Random(13)
    said = [sentence(rng, 1) + sentence(rng, 1) for _ in range(30000)]
    other = said.copy()
    other[0], other[-1], other[len(other) // 2] = "first", "last", "middle"
    texts = spark.createDataFrame([(1, " ".join(said)), (2, " ".join(other))], "h long, said string")
    pairs = line_dedup.stored(spark.createDataFrame([(1, 2)], "a long, b long"))
    whole = F.expr
    monkeypatch.setattr(F, "expr", lambda s: F.raise_error(F.lit(s)).cast("boolean") if s.startswith("levenshtein(said_a, said_b, allowed") else whole(s))
    assert [tuple(r) for r in line_dedup._similar(pairs, texts, 80).collect()] == [(1, 2)]


def test_later_links_join_components(spark):
    rng = random.Random(14)
    first = [(a, a + rng.randrange(1, 5)) for a in rng.sample(range(60), 25)]
    more = [tuple(sorted(rng.sample(range(70), 2))) for _ in range(20)]
    group = list(range(80))
    for a, b in first + more:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    member = line_dedup.components(frame(first)).select(F.col("vertex").alias("h"), "component")
    got = {r.h: r.component for r in line_dedup._joined(member, frame(more)).collect()}
    assert got == {h: group[h] for h in {h for pair in first + more for h in pair}}
    assert line_dedup._joined(member, frame([])).count() == member.count()


def test_a_pair_is_compared_once(spark, monkeypatch):
    # Lines of the same rare words in another order meet under every key, and are not similar.
    rng = random.Random(15)
    rows = []
    for k in range(12):
        words = [sentence(rng, 1) + sentence(rng, 1) + sentence(rng, 1) for _ in range(30)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[:29] + ["other"])), (10 * k + 2, " ".join(reversed(words)))]
    compared, similar = [], line_dedup._similar
    monkeypatch.setattr(line_dedup, "_similar", lambda pairs, texts, percent: compared.append([tuple(r) for r in pairs.select("a", "b").collect()]) or similar(pairs, texts, percent))
    gone = {r.doc_id for r in dedup_lines(documents(spark, rows), distance=None, removed="gone").where("size(gone) > 0").collect()}
    first, second = map(set, compared)
    assert len(first) > 12 and gone == {10 * k + 1 for k in range(12)}
    assert not first & second
