"""The corpus operators against brute force, on a small corpus with every odd case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridmill.llm import decontamination, links, media, mixing, perplexity, pii, repeats, secrets, similarity, tokens, toxicity

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, part int, token string, _hash bigint"


def corpus():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(3000))
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(12)]
    out = []
    for i, t in enumerate(base):
        out.append((i * 10, t, "s%d" % (i % 4)))
        near = t.split()
        near[60] = "changed"
        out.append((i * 10 + 1, " ".join(near), "s0"))
        far = t.split()
        for k in range(0, 120, 12):
            far[k] = "other%d" % k
        out.append((i * 10 + 2, " ".join(far), None))
    passage = " ".join(rng.choice(words) for _ in range(90))
    out += [(1000 + i, f"{rng.random()} {passage} {rng.random()}", "hot") for i in range(8)]
    out += [(2000 + i, base[0], "hot") for i in range(5)] + [(2000, base[0], "hot")]  # copies, and a repeated row
    out += [(3000, None, "s1"), (3001, "", None), (3002, " \t\n ", "s2"), (None, base[1], "s3"), (None, None, None), (3003, "one two", "s1"), (3004, "One  TWO", "s1"), (3005, long, "s2"), (3006, long[:9000], "s2"), (3007, "a" * 1500, "s3"), (3008, "é" * 700 + " ñandú 🙂", "s3")]
    return out


DOCS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2, "x", 3) for i, t, s in DOCS], KIND)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_mixing(spark, docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(DOCS) and mixing.mix(none).count() == 0
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = sum(size(t) for _, t, _ in DOCS)
    of = defaultdict(int)
    for _, t, s in DOCS:
        of[s] += size(t)
    order = sorted(of, key=lambda s: (s is None, s or ""))
    weight, target, open_ = {s: i % 3 + 1 for i, s in enumerate(order)}, {}, set(order)
    while True:
        left = total - sum(target.values())
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * of[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * of[s]
            open_.discard(s)
    left = total - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    largest, taken = max(size(t) for _, t, _ in DOCS), defaultdict(int)
    for r in got:
        assert r.source_size == of[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in order) and sum(taken.values()) <= total
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


@pytest.mark.parametrize("bucket", [perplexity.BUCKET_BYTES, 2000])
def test_perplexity(spark, docs, none, tmp_path, bucket, monkeypatch):
    monkeypatch.setattr(perplexity, "BUCKET_BYTES", bucket)
    folder = str(tmp_path / "model")
    facts = perplexity.train(docs.where("doc_id < 3000"), folder)
    got = perplexity.score(docs, folder, facts).collect()
    split = lambda t: [*(t or "").encode().lower().split(), perplexity.END]
    trained = [split(t) for i, t, _ in DOCS if i is not None and i < 3000]
    c = Counter(w for d in trained for w in d)
    b = Counter(p for d in trained for p in zip([perplexity.START, *d], d))
    n, v = sum(c.values()), len(c)
    d1 = perplexity.discounts([sum(x == k for x in b.values()) for k in (1, 2, 3, 4)])
    before, total, kinds = Counter(y for _, y in b), Counter(), defaultdict(lambda: [0, 0, 0])
    for (x, _), k in b.items():
        total[x] += k
        kinds[x][min(k, 3) - 1] += 1
    d2 = perplexity.discounts([sum(x == k for x in before.values()) for k in (1, 2, 3, 4)])
    rest = sum(d2[min(k, 3) - 1] for k in before.values()) / len(b) / (v + 1)
    low = lambda y: (max(before[y] - d2[min(before[y], 3) - 1], 0) / len(b) if before[y] else 0) + rest

    def p(x, y):
        if not total[x]:
            return low(y)
        k = b[x, y]
        return (max(k - d1[min(k, 3) - 1], 0) if k else 0) / total[x] + sum(a * z for a, z in zip(d1, kinds[x])) / total[x] * low(y)

    assert abs(sum(p(b"w1", y) for y in before) + p(b"w1", b"\0unseen") - 1) < 1e-9
    want = []
    for i, t, _ in DOCS:
        ws = split(t)
        want.append((i, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6), round(sum(math.log10(p(x, y)) for x, y in zip([perplexity.START, *ws], ws)), 6)))
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got], want)
    empty = perplexity.train(none, str(tmp_path / "none"))
    assert perplexity.score(docs, str(tmp_path / "none"), empty).count() == len(DOCS)


def test_similarity(spark, docs, none):
    sets = []
    for _, t, _ in DOCS:
        w = (t or "").encode().lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    root = list(range(len(DOCS)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(DOCS)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _, _) in enumerate(DOCS):
        if d is not None:
            least[find(i)].append(d)
    want = [(d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d) for i, (d, _, _) in enumerate(DOCS)]
    same(similarity.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect(), want)
    assert similarity.near_duplicates(none).count() == 0
    kept = similarity.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({find(i) for i in range(len(DOCS)) if sets[i]}) + sum(not s for s in sets)


def test_prefix_of_any_length_keeps_links():
    rng = np.random.default_rng(3)
    counts = np.zeros(1 << similarity.SKETCH_BITS, np.uint32)
    for _ in range(200):
        common = rng.integers(0, 2**63, 90).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 10).astype(np.uint64)])) for _ in range(2))
        for x in (a, b):
            np.add.at(counts, (x >> np.uint64(44)).astype(np.int64), 1)
        (pa_, la), (pb, lb) = similarity.prefix(a, counts, 0), similarity.prefix(b, counts, 0)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            shared, node, size = len(np.intersect1d(pa_, pb)), np.array([1, 2]), np.array([len(a) << 8 | la, len(b) << 8 | lb])
            assert shared >= similarity._pairs([np.array([0])], [np.array([1])], node, size).column(2)[0].as_py()


def test_components(spark, tmp_path):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(40)] + [(500, k) for k in range(600, 700)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = links.components(spark.createDataFrame(edges, "a bigint, b bigint"), str(tmp_path / "c")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root if find(x) != x} or {r.node: r.root for r in got} == {x: find(x) for x in root}


def test_tokens(spark, docs, none):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.vocabulary_path())
    got = tokens.tokenize_documents(docs).orderBy("start").collect()
    rows, start = sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), 0
    for r, (d, t, _) in zip(got, rows, strict=True):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        assert tuple(r) == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokens.tokenize_documents(none).count() == 0


def test_blocks_round_trip_and_index(tmp_path):
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0, np.uint32), np.array([2**32 - 1, 0], np.uint32), rng.integers(0, 49408, 4096).astype(np.uint32), np.where(rng.random(4000) < 0.01, 2**31, 7).astype(np.uint32)):
        assert (tokens.unpack_block(tokens.pack_block(ids)) == ids).all()
    lists = [rng.integers(0, 50000, n).astype(np.uint32) for n in (0, 5, 9000, 1, 4096)]
    path = tmp_path / "x"
    with open(path, "wb") as f:
        w = tokens.Writer(f)
        for x in lists:
            w.add(x, np.array([len(x)]))
        w.close()
    with open(path, "rb") as f:
        r = tokens.Reader(f, path.stat().st_size)
        assert all((r.document(i) == x).all() for i, x in enumerate(lists))


def test_pii(spark, docs, none):
    texts = {1: "mail a.b@c-d.org or +1 (456) 555-2186 now", 2: "card 4111 1111 1111 1111 and 4111111111111112", 3: "ip 10.0.0.256 or 10.0.0.1.2 v1.2.3.4", 4: "é🙂 x@y.z", 5: None, 6: "9" * 6000 + ".1.1.1"}
    got = {r.doc_id: [tuple(s) for s in r.base] for r in pii.find_personal_data(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert got == {1: [(0, 5, 16), (3, 20, 37)], 2: [(2, 5, 24)], 3: [(1, 17, 25), (1, 29, 36)], 4: [(0, 3, 8)], 5: [], 6: []}
    said = [(i, f"w{i} my badge is " + (f"u{i}@mail.com" if i % 2 else f"QX-{i:04d}") + " ok") for i in range(40)] + [(99, "it costs 500 now")]
    learnt = {r.doc_id for r in pii.find_personal_data(spark.createDataFrame(said, "doc_id bigint, text string")).where("size(learnt) > 0").collect()}
    assert learnt == set(range(0, 40, 2))
    assert pii.find_personal_data(docs).count() == len(DOCS) and pii.find_personal_data(none).count() == 0


def test_pii_learnt_words_induce_patterns(spark):
    said = [(i, f"w{i} my badge is " + (f"u{i}@mail.com" if i % 2 else f"QX-{i:04d}") + " ok") for i in range(40)]
    said += [(100 + i, f"z{i} door opens for " + (f"QX-{i:04d}" if i < 28 else f"ZT-{i:04d}") + " today") for i in range(0, 40, 2)]
    found = pii.find_personal_data(spark.createDataFrame(said, "doc_id bigint, text string"))
    learnt = {r.doc_id: [dict(said)[r.doc_id][s.start : s.end] for s in r.learnt] for r in found.where("size(learnt) > 0").collect()}
    first = {i: [f"QX-{i:04d}"] for i in range(0, 40, 2)}
    assert learnt == first | {100 + i: [f"QX-{i:04d}" if i < 28 else f"ZT-{i:04d}"] for i in range(0, 40, 2)}


def test_toxicity_finds_the_sentence(spark, none):
    rng = random.Random(4)
    plain = lambda: " ".join(rng.choice("abcdefghij") * 3 for _ in range(8)).capitalize() + "."
    rows = [(i, " ".join([plain(), "You total zorkhead fool." if i % 3 == 0 else plain(), plain()]), int(i % 3 == 0)) for i in range(240)]
    model = toxicity.fit([t for _, t, _ in rows[:180]], [y for *_, y in rows[:180]])
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows[180:]] + [(900, None), (901, "")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all((got[i].score >= 0.3) == bool(y) for i, _, y in rows[180:]) and got[900].score == got[901].score == 0
    t = rows[180][1].split()
    assert [t[s.first : s.last] for s in got[180].sentences] == [["You", "total", "zorkhead", "fool."]]
    assert toxicity.score_documents(none, model).count() == 0
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    few = toxicity.training_sample(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string"), labels, 20).collect()
    assert len(few) == 40 and sum(r.toxic for r in few) == 20


def test_toxicity_scores_are_noisy_or():
    """Scores against sentences cut and summed up one by one."""
    rng = random.Random(6)
    words = ["Fool", "you", "zork!", "end.", "(why?)", "--", "x", "Ünder", "long" * 5, "ok"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 7, 60, 300]))) for _ in range(60)] + ["", None, "  ", "..."]
    weights = np.random.default_rng(3).normal(0, 0.4, 1 << toxicity.LOG_FEATURES).astype(np.float32)
    got, _ = toxicity.Scorer(weights, -2.0, 0.7).score(pa.array(texts, pa.string()))
    for text, score in zip(texts, got):
        sentences, open_ = [], False
        for w in (text or "").split():
            if not open_ or len(sentences[-1]) == toxicity.LONGEST:
                sentences.append([])
            sentences[-1].append(w)
            open_ = not re.search(r"""[.!?]["')*$%&#]*$""", w)
        clean = 1.0
        for words_ in sentences:
            z = -2.0 + sum(float(weights[f]) for w in words_ for f in toxicity.features(re.sub(r"^[\W_]+|[\W_]+$", "", w.lower())))
            clean *= 1 - (1 / (1 + math.exp(-z))) ** toxicity.POWER
        odds = math.log((1 - clean) / clean) if 0 < clean < 1 else None
        assert score == pytest.approx(1 / (1 + math.exp(-odds - 0.7)) if odds is not None else 0.0, rel=1e-4, abs=1e-8)


def test_toxicity_slopes_are_the_gradient():
    z = np.array([-2.0, -0.3, 0.4, 1.2])

    def loss(z, label):
        clean = np.prod(1 - toxicity.sentence_scores(z))
        return -math.log(1 - clean if label else clean)

    p = toxicity.sentence_scores(z)
    for label in (0, 1):
        for k, slope in enumerate(toxicity.slopes(p, float(np.prod(1 - p)), label)):
            step = np.eye(4)[k] * 1e-6
            assert slope == pytest.approx((loss(z + step, label) - loss(z - step, label)) / 2e-6, rel=1e-5)


def test_toxicity_shift_is_the_best_cut():
    rng = np.random.default_rng(8)

    def mean(taken, labels, shares):
        hit = shares[taken & (labels == 1)].sum()
        return 2 * hit / (shares[taken].sum() + shares[labels == 1].sum())

    for _ in range(30):
        labels = rng.integers(0, 2, 40)
        scores = np.round(np.clip(rng.normal(0.3 + 0.2 * labels, 0.2), 0, 1), 1)  # with ties, zeros and ones
        shares = np.where(labels == 1, 1.0, 3.5)
        shift = toxicity.shift_for(scores, labels, shares)
        kept = toxicity.log_odds(scores) + shift >= toxicity.log_odds(np.array([toxicity.THRESHOLD]))[0]
        assert mean(kept, labels, shares) == pytest.approx(max(mean(scores > c, labels, shares) for c in set(scores.tolist()) - {scores.max()}))
    assert toxicity.shift_for(np.zeros(5), np.array([0, 1, 0, 1, 1]), np.ones(5)) == 0
    assert toxicity.fit([], [])[1:] == toxicity.fit(["a", None], [1, 1])[1:] == (-50.0, 0.0)


def test_media(spark, docs, none, tmp_path):
    media.write_archives(docs, str(tmp_path / "a"))
    got = media.media_features(spark.read.format("media_archive").option("path", str(tmp_path / "a")).load()).collect()
    want = []
    for d, t, _ in DOCS:
        own = (t or "").encode()
        p = own + b" " * (-len(own) % 192 if own else 192)
        want.append((d, len(own), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    same([(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got], want)
    media.write_archives(none, str(tmp_path / "b"))
    assert spark.read.format("media_archive").option("path", str(tmp_path / "b")).load().count() == 0


def test_members_are_tried_again_by_offset(tmp_path):
    writer = media.ArchiveWriter(str(tmp_path))
    name = writer.write(iter([pa.record_batch([pa.array([1, 2, 3]), pa.array(["a", "b" * 5000, "c"])], names=["doc_id", "text"])])).archive
    path, opened = tmp_path / name, []

    class Flaky:
        """Fails once in the middle of the second member."""

        def __init__(self):
            self.file = open(path, "rb")
            opened.append(self)

        def seek(self, n):
            self.at = n
            return self.file.seek(n)

        def read(self, n):
            if len(opened) == 1 and self.at > 0:
                raise OSError("lost")
            return self.file.read(n)

        def close(self):
            self.file.close()

    end = media._TAIL.unpack(path.read_bytes()[-media._TAIL.size :])[0]
    assert [m[0] for m in media.members(Flaky, 0, end, wait=0.001)] == [1, 2, 3] and len(opened) == 2
    path.write_bytes(path.read_bytes().replace(b"IDAT", b"IDAX", 1))
    with pytest.raises(media.Damaged):
        list(media.members(lambda: open(path, "rb"), 0, end, tries=2, wait=0.001))


def test_secrets(spark, none):
    texts = [(1, 'x password="abc123" y'), (2, "PassWord : token: abc123"), (3, "AKIA" + "A" * 16 + " AKIAshort"), (4, "f" * 24 + " é🙂 " + "0" * 30), (5, None), (6, "my ghp_" + "a1" * 20), (1, 'x password="abc123" y'), (None, "api_key=zzzzzz" * 40)]
    texts += [(7, "é api_key=zzzzzz" * 700 + "g" + "ab" * 12), (8, "a fed bead " * 40000 + "0" * 23 + "g" + "0f" * 12 + "g" + "c" * 25), (9, "AKIAAKIA AKIA" + "B" * 15 + "-AKIA" + "C" * 30)]

    def brute(t):
        out = []
        for n, r in enumerate(secrets.RULES):
            out += [(m.start(), n, m.end()) for m in re.finditer(r.pattern, t or "") if len(m.group(r.group)) >= r.least]
        return sorted(out)

    got = [(r.doc_id, [tuple(s)[:3] for s in r.found]) for r in secrets.scan_secrets(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()]
    assert sorted(got, key=str) == sorted([(d, brute(t)) for d, t in texts], key=str)
    assert secrets.scan_secrets(none).count() == 0 and secrets.trigram_query(r"[0-9a-f]+") == []
    assert {frozenset({"pas", "ass", "ssw", "swd"}) <= b for b in secrets.trigram_query("[Pp]asswd")} == {True}
    for r in secrets.RULES:
        branches = secrets.trigram_query(r.pattern)
        assert not any(x < y for x in branches for y in branches)


def test_secrets_candidates(spark):
    rows = spark.createDataFrame([(i if i else None, i % 3) for i in range(400)], "doc_id bigint, _hash bigint")
    hits = rows.where("doc_id % 20 = 0 OR doc_id IS NULL")
    said = {(r.doc_id, r._hash): r._maybe for r in secrets.may_be_candidates(rows, hits, ["doc_id", "_hash"]).collect()}
    sure = {(r.doc_id, r._hash) for r in hits.collect()}
    assert len(said) == 400 and all(said[k] for k in sure) and sum(said.values()) <= len(sure) + 2
    assert not any(r._maybe for r in secrets.may_be_candidates(rows, hits.limit(0), ["doc_id", "_hash"]).collect())


def test_decontamination(spark, docs, none):
    rng = random.Random(8)
    long = " ".join("b%d" % rng.randrange(40) for _ in range(30))
    items = [("i1", long), ("i2", "short item here"), ("i3", None), ("i2", "short item here"), (None, long.upper()), ("i9", "...")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    texts = [(1, "x y " + long.replace(" ", ", ", 5) + " z"), (2, "a short item. HERE b"), (3, " ".join(long.split()[3:12])), (4, None), (5, " ".join(long.split()[2:14]) + " q " * 30)]
    rows = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id bigint, text string, n_chars bigint")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def brute(t):
        w, hit, names = split(t), set(), set()
        for name, text in items:
            s = split(text)
            n = min(10, len(s))
            for a in range(len(s) - n + 1) if s else ():
                for k in range(len(w) - n + 1):
                    if w[k : k + n] == s[a : a + n]:
                        hit |= set(range(k, k + n))
                        names.add(name or "null")
        return len(w), len(hit), sorted(names)

    for block in (decontamination.BLOCK_WORDS, 10):
        got = decontamination.contamination(rows, bench, block_words=block).collect()
        assert [(r.doc_id, (r.n_words, r.n_hit, r.items)) for r in got] == [(i, brute(t)) for i, t in texts]
    kept = {r.doc_id: r for r in decontamination.decontaminate(rows, bench).collect()}
    assert kept == {r.doc_id: r for r in decontamination.decontaminate(rows, bench, block_words=10).collect()}
    assert set(kept) == {3, 4, 5} and brute(kept[5].text)[1] == 0 and kept[5].n_chars == len(kept[5].text) and kept[3].text == texts[2][1]
    assert decontamination.contamination(none, bench).count() == 0 and decontamination.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(3000):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 14))]
        assert repeats.suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("large", [repeats.LARGE, 1])
def test_repeats(spark, docs, none, large, monkeypatch):
    monkeypatch.setattr(repeats, "LARGE", large)
    n = repeats.LENGTH
    texts = [(t or "").encode() for _, t, _ in DOCS]
    seen = Counter(b[i : i + n] for b in texts for i in range(len(b) - n + 1))
    want = []
    for (d, _, _), b in zip(DOCS, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        want.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    same(repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), want)
    assert repeats.remove_repeats(none).count() == 0


def test_repeats_return_what_is_left(spark):
    """The text without its repeats, also where a run ends within a character; null stays null."""
    passage = " ".join("word%03d" % i for i in range(60))
    rows = [(1, "first " + passage + "é end"), (2, passage + "è other"), (3, "untouched é"), (4, None)]
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    n = len(passage) + 1  # é and è begin with the same byte
    assert got == {1: (n, "first  end"), 2: (n, " other"), 3: (0, "untouched é"), 4: (0, None)}


@pytest.mark.parametrize("step", ["meeting", "counted"])
def test_repeats_split_a_hot_key(spark, step, monkeypatch):
    """A passage in all texts is one key, and few strings, of most rows: adaptive execution can split the joins by them."""
    rng, plans, real = random.Random(8), [], repeats.keep
    words = lambda n: " ".join("%06x" % rng.randrange(1 << 24) for _ in range(n))
    passage = words(58)
    pairs = [words(140) for _ in range(60)]
    texts = [f"{words(60)} {passage} {words(60)}" for _ in range(500)] + [x for p in pairs for x in (p, p[1:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)

    def kept(df, path):
        out = real(df, path)
        if path.endswith(f"/{step}") or step == "counted" and path.endswith("/spans"):
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(repeats, "keep", kept)
    monkeypatch.setattr(repeats, "LARGE", 100)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        repeats.repeated_spans(docs).count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plans[0]


def test_pii_recall_of_planted_identifiers(spark):
    """Identifiers of no base form, some long, in brackets, or set off by signs, stand in
    contexts that base forms also stand in; decoys stand in running text."""
    rng = random.Random(6)
    words = ["w%s" % "abcdefgh"[i % 8] * (1 + i % 5) for i in range(60)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    contexts, rows, planted, decoys = ["badge no", "reach us under", "member code"], [], {}, set()
    for i in range(300):
        c = contexts[i % 3]
        if i % 2:
            rows.append((i, f"{prose(30)} {c}: u{i}@mail.com {prose(20)}"))
        else:
            one = f"QX-{i:04d}" + "z" * (90 if i % 10 == 0 else 0)
            rows.append((i, f"{prose(30)} {c} - ({one}), {prose(20)}"))
            planted[i] = one
    for i in range(300, 400):
        rows.append((i, f"{prose(12)} {rng.randrange(10**6)} {prose(9)}"))
        decoys.add(i)
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    text = dict(rows)
    learnt = {r.doc_id: [text[r.doc_id][s.start : s.end] for s in r.learnt] for r in got}
    assert sum(learnt[i] == [x] for i, x in planted.items()) >= 0.9 * len(planted)
    assert sum(bool(learnt[i]) for i in decoys) <= 0.02 * len(decoys)
    assert all(s.kind == 0 for r in got if r.doc_id in planted for s in r.learnt)
