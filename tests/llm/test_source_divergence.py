import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerfold.llm import source_divergence
from tests.llm.cases import sentence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, value int"


def table(spark, rows):
    return spark.createDataFrame([(k, *r, 7, "x", None) for k, r in enumerate(rows)], SCHEMA).repartition(3)


def rows(seed=1, sources=7, docs=400):
    rng = random.Random(seed)
    common = [sentence(rng, 60).split(" ") for _ in range(3)]
    out = []
    for _ in range(docs):
        s = int(rng.paretovariate(1)) % sources
        own = common[s % 3]
        out.append((" ".join(rng.choice(own + ["The", "the,and", "Été", "ÉTÉ", f"w{s}x"]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "en", "de", None, "rare"[: rng.randint(3, 4)]]), f"s{s}" if s else None))
    return out + [(None, "en", "empty"), ("", "en", "empty2"), ("1 2 3 --", "zz", "only"), ("term", "zz", "other"), (None, None, None), ("long " * 50000, "en", "s1"), out[0], out[0], ("é\U0001f600 ｚ", "en", "\U0001f600"), ("x", "en", "ｚ")]


def brute(table_rows, least=30, top=50):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in table_rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        said = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        count[lang, source].update(said)
        docs[lang].update(set(said))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * len(kept)) for t in kept}
        shares = {s: share(count[lang, s]) for l, s in groups if l == lang}
        whole = share(sum((count[lang, s] for s in shares), Counter()))
        for s, p in shares.items():
            pairs = [(o, sum(abs(p[t] - q[t]) for t in kept)) for o, q in shares.items() if o != s]
            terms = [(t, p[t] - whole[t]) for t in kept if count[lang, s][t] and p[t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit], 1)]
    return sorted(out)


@pytest.mark.parametrize("case", [rows(), rows(2, 40, 900)])
def test_audit_against_counting(spark, case):
    got = source_divergence.audit(table(spark, case))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(case)


def test_small_tiles_blocks_and_flushes_give_the_same(spark, monkeypatch):
    case = rows(3, 12, 500)
    monkeypatch.setattr(source_divergence, "TILE", 16)
    monkeypatch.setattr(source_divergence, "BLOCK", 3)
    monkeypatch.setattr(source_divergence, "HELD_ROWS", 50)
    got = source_divergence.audit(table(spark, case), 3, 5)
    assert sorted(map(tuple, got.collect())) == brute(case, 3, 5)


def test_joint_walk_meets_all_cells(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(source_divergence, "WALK", 64)
    for rows_a, rows_b, columns, share in ((5, 3, 40, 0.1), (1, 9, 7, 0.5), (6, 6, 16, 0.0), (8, 2, 1, 0.9)):
        a, b = ((rng.random((r, columns)) < share) * rng.integers(1, 99, (r, columns)) for r in (rows_a, rows_b))
        trees = [source_divergence.Tree(*np.nonzero(m), m[np.nonzero(m)], 6) for m in (a, b)]
        for t, m in zip(trees, (a, b)):
            assert t.bits[-1].sum() == (m > 0).sum() if len(t.bits[-1]) else not m.any()
        met = Counter(x for part in source_divergence.joint_leaves(*trees, rows_a, rows_b, False) for x in zip(*(y.tolist() for y in part)))
        assert met == Counter((i, j, int(a[i, c]), int(b[j, c])) for i in range(rows_a) for j in range(rows_b) for c in range(columns) if a[i, c] or b[j, c])
        same = Counter(x for part in source_divergence.joint_leaves(trees[0], trees[0], rows_a, rows_a, True) for x in zip(*(y.tolist() for y in part)))
        assert same == Counter((i, j, int(a[i, c]), int(a[j, c])) for i in range(rows_a) for j in range(i + 1, rows_a) for c in range(columns) if a[i, c] or a[j, c])


def test_shares_of_huge_counts():
    count, whole = np.array([0, 8 * 10**15, 10**9]), np.array([8 * 10**15 + 5, 8 * 10**15 + 5, 3 * 10**9])
    assert source_divergence._shares(count, whole).tolist() == [1 + 10**9 * (c + 5) // w for c, w in zip(count.tolist(), whole.tolist())]


def test_empty_table(spark):
    assert source_divergence.audit(table(spark, [])).collect() == []
