"""SentencePiece encoding by sampling without replacement, and decoding.

The pieces of a vocabulary file span a lattice over a text's bytes (blanks are the word mark
and one precedes the text; characters without a piece become byte pieces). A piece's weight
falls with its rank (rank + 2) ** -alpha, byte pieces weigh less than all others, and a
segmentation's probability is the product of its weights over the lattice's total. The
search draws `samples` distinct segmentations: the whole lattice gets a Gumbel value, a popped
region is split at every step of one sampled path into that path and what branches off there,
each branch gets the largest Gumbel value that it would have below its parent's
(truncated), and the region with the largest value is popped next (A-star on perturbed log
probabilities). That is Gumbel top-k over all segmentations. `log_inclusion` is the log
chance of a segmentation to beat the value that the search left on top.

All random numbers are hashes of the row key, the sample and the place, so a row's
samples depend neither on partitions nor on retries. `decode` gives back the text exactly.

Defined cases: null and empty text have one segmentation, without pieces; texts with fewer
segmentations than asked give all of them, with inclusion 1; a null key counts as 0, and rows
with equal keys and texts get equal samples; other columns are not read. What branches off a
path behind a prefix whose probability is below e**-40 is not followed; all segmentations with
that prefix together have no more than that probability, 4e-18, which is below the step of
the random numbers (2**-52).

Scale: one pass without a shuffle. Pieces never cross a blank that follows something else,
so lattices are built once for each distinct run of a chunk, and all runs of a chunk are walked,
and all its rows searched, together in arrays. The vocabulary (its size is fixed by the file) is broadcast."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerfold.llm.words import BYTE_VALUE, Sums, buffers, chunks, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 3
ALPHA = 1.0
CHUNK = 1 << 17
MARK = "▁"
_SLOTS = 17
LEAST = -40.0
PREFIX = 4
#: Steps of all paths that are looked at together for branches.
WINDOW = 64


@dataclass
class Pieces:
    """Pieces as bytes (a blank for the mark), one weight each, and hash tables by length in bytes."""

    flat: np.ndarray
    offsets: np.ndarray
    weight: np.ndarray
    first_byte: int
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    short: dict[int, np.ndarray]  # pieces of one and two bytes by those bytes
    alone: np.ndarray  # bytes that no longer piece holds
    reach: np.ndarray  # how long pieces get that begin with the same `PREFIX` bytes, by their hash


def load_pieces(path: str = MODEL, alpha: float = ALPHA) -> Pieces:
    """Read on the driver; executors get it by broadcast and need no file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    raw, rank, whole = [b""] * size, np.full(size, np.inf), []
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            raw[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            raw[i] = piece.replace(MARK, " ").encode()
            rank[i] = min(-model.get_score(i), size)
            whole.append(i)
            if " " in raw[i].decode().lstrip(" "):
                raise ValueError(f"piece {piece!r} holds a blank behind other characters")
    weight = np.where(np.isfinite(rank), -alpha * np.log(np.minimum(rank, size) + 2), -alpha * math.log(4 * size))
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    flat = np.frombuffer(b"".join(raw), np.uint8)
    ids = np.array(whole)
    hashes = Sums(BYTE_VALUE[flat]).hashed(offsets[ids], offsets[ids + 1])
    length = offsets[ids + 1] - offsets[ids]
    reach = np.zeros(1 << _SLOTS, np.int32)
    long = length > PREFIX
    np.maximum.at(reach, Sums(BYTE_VALUE[flat]).hashed(offsets[ids[long]], offsets[ids[long]] + PREFIX) >> np.uint64(64 - _SLOTS), length[long])
    tables = {}
    for n in np.unique(length).tolist():
        mine = length == n
        order = np.argsort(hashes[mine])
        near = np.zeros(1 << _SLOTS, bool)
        near[hashes[mine] >> np.uint64(64 - _SLOTS)] = True
        tables[n] = (hashes[mine][order], ids[mine][order], near)
    short = {1: np.full(1 << 8, -1), 2: np.full(1 << 16, -1)}
    for i in whole:
        if len(raw[i]) <= 2:
            short[len(raw[i])][int.from_bytes(raw[i])] = i
    alone = np.ones(256, bool)
    alone[0x20:] = False
    alone[np.concatenate([np.frombuffer(raw[i], np.uint8) for i in whole if len(raw[i]) > 1])] = False
    alone[0x7F] = not any(b"\x7f" in raw[i] for i in whole)
    return Pieces(flat, offsets, weight, model.piece_to_id("<0x00>"), tables, short, alone, reach)


# -- runs and lattices -----------------------------------------------------------------------


def _runs(offsets: np.ndarray, buf: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Where runs begin: at blanks behind something else, around bytes that stand alone, and at texts."""
    begin = np.zeros(len(buf), bool)
    begin[1:] = ((buf[1:] == 0x20) & (buf[:-1] != 0x20)) | alone[buf[1:]] | alone[buf[:-1]]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begin)


@dataclass
class Lattice:
    """Edges sorted by the byte where they start, those of one byte by falling length."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    chance: np.ndarray
    log_chance: np.ndarray
    upto: np.ndarray  # chances of a byte's edges up to this one; above 1 at the last one
    first: np.ndarray  # each byte's first edge
    degree: np.ndarray  # edges that start where this one does
    run_end: np.ndarray  # for each byte, where its run ends
    closes: np.ndarray  # edges that end their run


def _matches(buf: np.ndarray, run_end: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of every piece at every place, in the order of starts."""
    sums = Sums(BYTE_VALUE[buf])
    starts, sizes, ids = [], [], []
    room = np.arange(len(buf))  # places with enough bytes behind them
    reach = None
    for n, (known, piece, near) in pieces.tables.items():
        enough = run_end[room] - room >= n
        if n > PREFIX:
            if reach is None:
                room = room[enough]
                reach = pieces.reach[sums.hashed(room, room + PREFIX) >> np.uint64(64 - _SLOTS)]
                enough = np.ones(len(room), bool)
            enough &= reach >= n
            reach = reach[enough]
        room = room[enough]
        if n <= 2:
            found = pieces.short[n][buf[room] if n == 1 else buf[room].astype(np.int64) << 8 | buf[room + 1]]
            at, found = room[found >= 0], found[found >= 0]
        else:
            h = sums.hashed(room, room + n)
            hit = near[h >> np.uint64(64 - _SLOTS)]
            at, h = room[hit], h[hit]
            spot = np.minimum(np.searchsorted(known, h), len(known) - 1)
            same = known[spot] == h
            at, found = at[same], piece[spot[same]]
        starts.append(at)
        sizes.append(np.full(len(at), n))
        ids.append(found)
    # Characters without a piece of their own: bytes one by one.
    head = np.flatnonzero((buf & 0xC0) != 0x80)
    size = np.diff(np.append(head, len(buf)))
    whole = np.zeros(len(buf), bool)
    for at, n in zip(starts, pieces.tables, strict=True):
        if n <= 4:
            whole[at[_char_size(buf[at]) == n]] = True
    missing = np.zeros(len(buf) + 1, np.int64)
    missing[head[~whole[head]]] = 1
    missing[(head + size)[~whole[head]]] -= 1
    spread = np.flatnonzero(np.cumsum(missing)[:-1] > 0)
    start = np.concatenate([spread, *starts[::-1]])
    order = np.argsort(start, kind="stable")  # of one place the longest first, which is mostly the likeliest
    end = start + np.concatenate([np.ones(len(spread), np.int64), *sizes[::-1]])
    piece = np.concatenate([pieces.first_byte + buf[spread].astype(np.int64), *ids[::-1]])
    return start[order], end[order], piece[order]


def _log_chances(start: np.ndarray, end: np.ndarray, weight: np.ndarray, run_end: np.ndarray) -> np.ndarray:
    """Log chance of each edge at its start: backward sums of weights, all runs at once, from their ends on."""
    far = run_end[start] - start
    order = np.argsort(far.astype(np.uint16) if len(far) and far.max() < 1 << 16 else far, kind="stable")
    start, end, far, weight = start[order], end[order], far[order], weight[order]
    total = np.zeros(len(run_end) + 1)
    value = np.empty(len(start))
    last = np.append(run_end, 0)
    cuts = np.flatnonzero(np.diff(far, prepend=-1, append=-1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        s, e = start[a:b], end[a:b]
        x = weight[a:b] + np.where(e == last[s], 0.0, total[e])
        group = np.flatnonzero(np.diff(s, prepend=-1))
        reps = np.diff(np.append(group, b - a))
        top = np.maximum.reduceat(x, group)
        z = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, reps)), group))
        total[s[group]] = z
        value[a:b] = x - np.repeat(z, reps)
    out = np.empty(len(start))
    out[order] = value
    return out


def _lattice(buf: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> Lattice:
    run_end = np.repeat(offsets[1:], np.diff(offsets))
    start, end, piece = _matches(buf, run_end, pieces)
    value = _log_chances(start, end, pieces.weight[piece], run_end)
    chance = np.exp(value)
    first = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(buf)))])
    group = np.flatnonzero(np.diff(start, prepend=-1))
    degree = np.repeat(np.diff(np.append(group, len(start))), np.diff(np.append(group, len(start))))
    running = np.cumsum(chance)
    upto = running - np.repeat(running[group] - chance[group], np.diff(np.append(group, len(start))))
    upto[np.append(group[1:], len(start))[: len(group)] - 1] = 2.0
    return Lattice(start, end, piece, chance, value, upto, first, degree, run_end, end == run_end[start])


def _char_size(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


# -- sampling --------------------------------------------------------------------------------


def _uniform(number: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit ones."""
    return ((mix(number) >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


_ALL = (1 << 64) - 1


def _seed(*parts: int) -> int:
    """One number from several, in plain integers."""
    h = 0
    for p in parts:
        h = (h + p + 0x9E3779B97F4A7C15) & _ALL
        h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & _ALL
        h = ((h ^ h >> 27) * 0x94D049BB133111EB) & _ALL
        h ^= h >> 31
    return h


def _below(mean: np.ndarray, limit: float, u: np.ndarray) -> np.ndarray:
    """Gumbel values of the given log masses, each the largest of its region, cut off at the limit."""
    wait = -np.log(u)
    return np.minimum(mean - np.log(np.exp(np.minimum(mean - limit, 700.0)) + wait), limit)


def _walk(lattice: Lattice, begin: np.ndarray, end: np.ndarray, key: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """A random path for every run: its edges one after the other, and where each run's begin."""
    active, node, depth = np.arange(len(begin)), begin.copy(), 0
    who, what = [], []
    while len(active):
        u = _uniform(key[active] + np.uint64(_seed(4, sample, depth)))
        edge = lattice.first[node]
        open_ = np.flatnonzero(lattice.upto[edge] <= u)
        while len(open_):
            edge[open_] += 1
            open_ = open_[lattice.upto[edge[open_]] <= u[open_]]
        who.append(active)
        what.append(edge)
        node = lattice.end[edge]
        more = node != end[active]
        active, node = active[more], node[more]
        depth += 1
    steps = np.zeros(len(begin), np.int64)
    for w in who:
        steps[w] += 1
    first = np.concatenate([[0], np.cumsum(steps)])
    out = np.empty(first[-1], np.int64)
    for d, (w, e) in enumerate(zip(who, what, strict=True)):
        out[first[w] + d] = e
    return out, first


def _branches(lattice: Lattice, flat: np.ndarray, begin: np.ndarray, end: np.ndarray, gone: tuple[np.ndarray, np.ndarray], before: np.ndarray, value: np.ndarray,
              seed: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What branches off each path flat[begin:end]: its `samples` largest values (-inf where there are fewer), their steps behind
    `begin`, and the log chances up to there. gone: chance and number of the edges that are gone already at the first step."""
    n = len(begin)
    best, where, ahead_of = np.full((n, samples), -np.inf), np.zeros((n, samples), np.int64), np.zeros((n, samples))
    before, rows, offset, window = before.copy(), np.flatnonzero(begin < end), 0, WINDOW
    while len(rows):
        far = offset + np.arange(min(window, int((end - begin)[rows].max()) - offset))
        step, stop = begin[rows, None] + far, end[rows, None]
        edge = flat[np.minimum(step, stop - 1)]
        log = np.where(step < stop, lattice.log_chance[edge], 0.0)
        upto = before[rows, None] + np.cumsum(log, 1)
        ahead, rest, left = upto - log, 1.0 - lattice.chance[edge], lattice.degree[edge] - 1
        if offset == 0:
            rest[:, 0] -= gone[0][rows]
            left[:, 0] -= gone[1][rows]
        r, c = np.nonzero((step < stop) & (left > 0) & (rest > 0) & (ahead > LEAST))
        values = np.full(step.shape, -np.inf)
        values[r, c] = _below(ahead[r, c] + np.log(rest[r, c]), value[rows[r]], _uniform(seed[rows[r]] + far[c].astype(np.uint64)))
        both = np.concatenate([best[rows], values], 1)
        top = np.argsort(-both, 1, kind="stable")[:, :samples]
        for kept, found in ((best, values), (where, np.broadcast_to(far, step.shape)), (ahead_of, ahead)):
            kept[rows] = np.take_along_axis(np.concatenate([kept[rows], found], 1), top, 1)
        before[rows] = upto[:, -1]
        offset, window = offset + window, 2 * window
        rows = rows[(upto[:, -1] > LEAST) & (begin[rows] + offset < end[rows])]
    return best, where, ahead_of


def _branch(lattice: Lattice, node: int, taken: tuple[int, ...], seed: int) -> list[int]:
    """A random path from the node to the end of its run, whose first edge is none of those taken."""
    low, stop = int(lattice.first[node]), int(lattice.run_end[node])
    free = [e for e in range(low, low + int(lattice.degree[low])) if e not in taken]
    chances = lattice.chance[free].tolist()
    left, edge = ((_seed(seed, 0) >> 12) + 0.5) / (1 << 52) * sum(chances), free[-1]
    for e, chance in zip(free, chances, strict=True):
        left -= chance
        if left < 0:
            edge = e
            break
    path = [edge]
    while (node := int(lattice.end[edge])) != stop:
        u = ((_seed(seed, len(path)) >> 12) + 0.5) / (1 << 52)
        edge = int(lattice.first[node])
        while lattice.upto[edge] <= u:
            edge += 1
        path.append(edge)
    return path


@dataclass
class _Round:
    """One drawn path for each row, from where on it was split, and what branches off there."""

    flat: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    taken: list[tuple[int, ...]]
    step: np.ndarray
    ahead: np.ndarray


def _search(lattice: Lattice, fresh: list[np.ndarray], fresh_first: list[np.ndarray], first_run: np.ndarray, keys: np.ndarray, samples: int) -> tuple[list[dict[int, float]], list[_Round], np.ndarray]:
    """The search of all rows at once, a sample a round: for each round the values of the rows that have one, the paths, and at
    last the value on top of each row's agenda. fresh: every run's own random path for each sample."""
    n = len(keys)
    agenda = np.full((n, samples * samples), -np.inf)
    rounds, values = [], []
    for j in range(samples):
        found, begin, before = {}, np.zeros(n, np.int64), np.zeros(n)
        gone = np.zeros(n), np.zeros(n, np.int64)
        if j == 0:
            flat, first, taken = fresh[0], fresh_first[0][first_run], [()] * n
            found = {r: -math.log(-math.log((_seed(int(keys[r]), 3) >> 12) / (1 << 52) + 2.0**-54)) for r in range(n)}
        else:
            spot = agenda.argmax(1)
            drawn, taken, size = [], [()] * n, np.zeros(n, np.int64)
            for r in np.flatnonzero(agenda[np.arange(n), spot] > -np.inf).tolist():
                own, slot = rounds[spot[r] // samples], spot[r] % samples
                path = own.flat[own.first[r] : own.first[r + 1]]
                step = int(own.step[r, slot])
                at = int(own.begin[r]) + step
                taken[r] = (*own.taken[r], int(path[at])) if step == 0 else (int(path[at]),)
                branch = _branch(lattice, int(lattice.start[path[at]]), taken[r], _seed(int(keys[r]), 2, j))
                run = int(first_run[r]) + int(np.count_nonzero(lattice.closes[path[:at]])) + 1
                drawn += [path[:at], branch, fresh[j][fresh_first[j][run] : fresh_first[j][first_run[r + 1]]]]
                size[r] = sum(map(len, drawn[-3:]))
                begin[r], before[r], found[r] = at, own.ahead[r, slot], float(agenda[r, spot[r]])
                gone[0][r], gone[1][r] = sum(lattice.chance[e] for e in taken[r]), len(taken[r])
                agenda[r, spot[r]] = -np.inf
            flat = np.concatenate(drawn).astype(np.int64) if drawn else np.zeros(0, np.int64)
            first = np.concatenate([[0], np.cumsum(size)])
        value = np.array([found.get(r, -np.inf) for r in range(n)])
        has = np.array([r in found for r in range(n)], bool)
        start = first[:-1] + begin
        best, step, ahead = _branches(lattice, flat, start, np.where(has, first[1:], start), gone, before, value, mix(mix(keys.astype(np.uint64)) + np.uint64(_seed(1, j))), samples)
        agenda[:, j * samples : (j + 1) * samples] = best
        rounds.append(_Round(flat, first, begin, taken, step, ahead))
        values.append(found)
    return values, rounds, agenda.max(1)


def sample_batch(text: pa.Array, keys: np.ndarray, pieces: Pieces, samples: int) -> tuple[np.ndarray, ...]:
    """For every row and sample: row, sample, log probability, value, log inclusion; and the pieces, with where each sample's begin."""
    old, raw = buffers(text)
    n_rows, full = len(text), np.diff(old) > 0
    # One blank goes before every text that is not empty.
    buf = np.insert(raw, old[:-1][full], 0x20)
    offsets = old + np.concatenate([[0], np.cumsum(full)])
    begin = _runs(offsets, buf, pieces.alone)
    end = np.append(begin[1:], len(buf))
    first_run = np.searchsorted(begin, offsets)
    _, one, same = np.unique(Sums(BYTE_VALUE[buf]).hashed(begin, end), return_index=True, return_inverse=True)
    size = (end - begin)[one]
    edges = np.concatenate([[0], np.cumsum(size)])
    distinct = buf[np.repeat(begin[one] - edges[:-1], size) + np.arange(edges[-1])]
    lattice = _lattice(distinct, edges, pieces)
    row = np.repeat(np.arange(n_rows), np.diff(first_run))
    run_key = mix(mix(keys.astype(np.uint64))[row] + (np.arange(len(row)) - first_run[:-1][row]).astype(np.uint64))
    paths = [_walk(lattice, edges[:-1][same], edges[1:][same], run_key, j) for j in range(samples)]
    values, rounds, limits = _search(lattice, [p for p, _ in paths], [f for _, f in paths], first_run, keys, samples)
    logs = [lattice.log_chance[own.flat] for own in rounds]
    out_row, out_sample, out_log, out_value, out_incl, out_path = [], [], [], [], [], []
    for r, limit in enumerate(limits.tolist()):
        for j, own in enumerate(rounds):
            if r not in values[j]:
                break
            a, b = own.first[r], own.first[r + 1]
            log = float(logs[j][a:b].sum())
            x = log - limit
            out_row.append(r)
            out_sample.append(j)
            out_log.append(log)
            out_value.append(values[j][r])
            out_incl.append(x if x < -30 else (0.0 if x > 5 else math.log(-math.expm1(-math.exp(x)))))
            out_path.append(own.flat[a:b])
    first = np.concatenate([[0], np.cumsum([len(p) for p in out_path])]).astype(np.int64)
    ids = lattice.piece[np.concatenate(out_path)] if out_path else np.zeros(0, np.int64)
    return np.array(out_row, np.int64), np.array(out_sample), np.array(out_log), np.array(out_value), np.array(out_incl), ids.astype(np.int32), first


def decode_batch(ids: np.ndarray, first: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins (one more at the end)."""
    size = pieces.offsets[ids + 1] - pieces.offsets[ids]
    at = np.concatenate([[0], np.cumsum(size)])
    flat = pieces.flat[np.repeat(pieces.offsets[ids] - at[:-1], size) + np.arange(at[-1])]
    edges = at[first]
    full = np.diff(edges) > 0
    return np.delete(flat, edges[:-1][full]), edges - np.concatenate([[0], np.cumsum(full)])


# -- operators -------------------------------------------------------------------------------

SAMPLED = T.StructType([T.StructField("sample", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
                        T.StructField("log_prob", T.DoubleType()), T.StructField("perturbed", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()), T.StructField("decodes", T.BooleanType())])


def encode(docs: DataFrame, pieces: Pieces, *, samples: int = SAMPLES, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """For every document its key and up to `samples` segmentations; `decodes` tells that the pieces give back the text."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([docs.schema[key], *SAMPLED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            texts = batch.column(2)
            row, sample, log, value, incl, ids, first = sample_batch(texts, batch.column(1).to_numpy(), shared.value, samples)
            flat, edges = decode_batch(ids, first, shared.value)
            offsets, raw = buffers(texts)
            said, want = flat.tobytes(), raw.tobytes()
            same = [said[a:b] == want[c:d] for a, b, c, d in zip(edges[:-1].tolist(), edges[1:].tolist(), offsets[row].tolist(), offsets[row + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(sample, pa.int32()), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids)), pa.array(np.diff(first)),
                pa.array(log), pa.array(value), pa.array(incl), pa.array(same, pa.bool_())], names=schema.names)

    number = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed))
    return docs.select(F.col(key).alias("key"), number.alias("number"), F.col(text).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, pieces: Pieces, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their pieces; null pieces give null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*encoded.schema, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, edges = decode_batch(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(size)]), shared.value)
            raw = flat.tobytes()
            texts = [raw[a:b].decode() if ok else None for a, b, ok in zip(edges[:-1].tolist(), edges[1:].tolist(), column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)
