"""Ranked search and the conversation trie against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gridmill.llm import search, turns

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top):
    held = [(i, Counter(cut(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    of = defaultdict(set)
    for i, t in items:
        of[i] |= set(cut(t))
    out = []
    for item, terms in of.items():
        scored = []
        for i, c in held:
            m = 100 - 90 + (90 * c.total() * n_docs) // length if c else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_terms", [search.BLOCK_TERMS, 12])
@pytest.mark.parametrize("window", [search.WINDOW, 40])
def test_search(spark, monkeypatch, block_terms, window):
    random.seed(block_terms + window)
    monkeypatch.setattr(search, "WINDOW", window)
    monkeypatch.setattr(search, "CHUNK", 64)
    words = ["A", "b", "Ça", "d9", "ÉÉ", "ſ", "K", "x1y", "zz", "漢字", "q", "r", "s"]
    text = lambda n: "".join(random.choice(words) + random.choice([" ", ".", "\n", "_", "\x00"]) for _ in range(random.randint(0, n)))
    docs = [(random.choice([k, k, None]), random.choice([text(30), text(30), None, "", "..."])) for k in range(60)] + [(7, "b b zz")] * 12 + [(5, "zz " * 4000)]
    items = [(1, "a b zz"), (1, "Q r"), (2, text(20)), (None, "ça éé"), (3, None), (4, "nowhere"), (5, " ".join(words))]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, term int, score int")
    b = spark.createDataFrame([(t, i, 3) for i, t in items], "text string, item_id int, block int")
    got = search.best_documents(d, b, top=5, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items, 5)


def test_search_of_nothing(spark):
    d, b = spark.createDataFrame([("x", "a b")], "doc_id string, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert [tuple(r)[:3] for r in search.best_documents(d, b).collect()] == [(1, 1, "x")]
    assert search.best_documents(d.limit(0), b).count() == 0 and search.best_documents(d, b.limit(0)).count() == 0


def trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + x[h:])
    members = defaultdict(list)
    for c, x in built.items():
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [w for w in members if w[: len(node)] == node]
        inner = {w[:-1] for w in members if w}
        saved = sum((len(members[w]) - 1) * len(w[-1][1].encode()) for w in below if w)
        ends = ",".join(map(str, sorted(c for c in cs if built[c] == node)))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), sum(len(w) == len(node) + 1 for w in below), sum(w not in inner for w in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie(spark, monkeypatch):
    random.seed(3)
    monkeypatch.setattr(turns, "CHUNK", 3)
    rows = [(1, None, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, None, "b"), (None, 3, "u", "x"), (2, 1, "u", None), (2, 1, None, None), (7, 0, "u", "zz"), (5, 1, "a", "é"), (5, 2, "a", "é"), (6, None, None, None)]
    rows += [(c, i, "u", "t%d" % (i % 3)) for c, n in ((10, 40), (11, 38), (12, 40), (13, 8), (14, 9), (15, 16)) for i in range(n)]
    rows += [(20, 700 * i - 3000, "u", "t%d" % (i % 3)) for i in range(30)] + [(-3, 1, "u", "q"), (-5, 2, "u", "n"), (-8, 2, "u", "n")]
    rows += [(c, i, random.choice("uv"), random.choice("pq")) for c in range(30, 120) for i in range(random.randint(1, 12))]
    table = spark.createDataFrame([(*r, 9, 9) for r in rows], "conv_id long, turn long, role string, text string, pos int, block int")
    got = turns.prefix_trie(table)
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)
    assert turns.prefix_trie(table.limit(0)).count() == 0
    plain = turns.prefix_trie(table.where("conv_id IN (10, 11)"), rebuilt=False).where("depth IN (0, 38, 39)")
    assert sorted((r.depth, r.n_convs) for r in plain.collect()) == [(0, 2), (38, 2), (39, 1)]


def test_a_table_of_turnless_conversations(spark):
    rows = [(c, 0, "u", "x") for c in range(1, 40) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    got = turns.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in got.collect()] == trie(rows) and got.count() == 1
