import random
import re
from collections import Counter, defaultdict

import pytest

from larkspur.llm import divergence

from .helpers import DOCS, awkward, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    held, n = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        held[lang or ""].update(set(terms))
        n[lang or "", source or ""].update(terms)
    out = []
    for lang in held.keys() | {g[0] for g in n}:
        kept = [t for t, d in held[lang].items() if d >= least]
        groups = {s: c for (g, s), c in n.items() if g == lang}

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        for s, c in groups.items():
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if c[t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, x.decode(), -v, i + 1) for i, (v, x) in enumerate(ranked)]
    return sorted(out)


def some(seed, n, sources):
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "xyzé漢"]
    return [(i, " 1-".join(draw.choice(vocabulary) for _ in range(draw.randrange(40))).title(), draw.choice(["en", "fr"]), f"s{draw.randrange(sources)}", 0) for i in range(n)]


@pytest.mark.parametrize(("width", "block", "blocks"), [(divergence.SLICE, divergence.BLOCK, 3), (7, 1, 1), (20, 2, 4), (20, 64, 8)])
def test_equals_brute_force(spark, width, block, blocks):
    """Blocks of several sizes, odd and even in number, and vocabularies in slices."""
    rows = some(width, 150, 7) + [(1, None, None, None, None), (2, "12 ..", "de", "x", 0), (2, "12 ..", "de", None, 0), (3, "", "en", "void", 0)] * 2
    out = divergence.audit(spark.createDataFrame(rows, DOCS), 5, 6, width=width, block=block, blocks=blocks)
    assert sorted(tuple(r) for r in out.collect()) == brute([(r[1], r[2], r[3]) for r in rows], 5, 6)


@pytest.mark.parametrize("blocks", range(1, 12))
def test_every_two_blocks_meet_once(blocks):
    meetings = [r for r in divergence.rounds(blocks)]
    assert sorted(tuple(sorted(m)) for r in meetings for m in r) == [(a, b) for a in range(blocks) for b in range(a + 1, blocks)]
    assert all(len({x for m in r for x in m}) == 2 * len(r) for r in meetings)


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_tables(spark, make):
    docs = make(spark)
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert sorted(tuple(r) for r in divergence.audit(docs, 1, 50).collect()) == brute(rows, 1, 50)
