"""Each method against a brute-force version, a round trip or held-out data."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from wordmill.llm import chat, decontaminate, lines, minhash, mixing, paragraphs, pii, quality, tokens, warc
from wordmill.llm.components import components
from wordmill.llm.stage import Stages
from wordmill.llm.text import Hasher, slices, split_words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def query(spark, name):
    return __spark_entry__.queries()[name](spark, SF)


def partition(pairs):
    groups = defaultdict(set)
    for item, group in pairs:
        groups[group].add(item)
    return {frozenset(g) for g in groups.values()}


def joined(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def runs(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


# -- text ---------------------------------------------------------------------------


def test_words_match_the_pattern():
    texts = ["a b\tc\nd\x0be\x0cf\rg", "", "  x  ", "é ß日本 𝒳 y  z", None, "a" * 50]
    w = split_words(pa.array(texts))
    raw = w.data.tobytes()
    got = [raw[a:b].decode() for a, b in zip(w.start, w.end)]
    want = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    assert got == [x for t in want for x in t] and w.n.tolist() == [len(t) for t in want]


def test_hash_depends_on_the_word_alone(monkeypatch):
    from wordmill.llm import text

    words = ["alpha", "beta", "x" * 100, "alpha", "é"]
    monkeypatch.setattr(text, "POWER_BYTES", 64)
    w = split_words(pa.array([" ".join(words), "beta alpha " + "x" * 100]))
    h = Hasher().words(w.data, w.start, w.end).tolist()
    assert h[0] == h[3] == h[6] and h[1] == h[5] and h[2] == h[7] and len(set(h)) == 4


def test_slices_keep_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "c" * 10, "", "d"], "k": [1, 2, 3, 4, 5]})
    parts = list(slices(iter([batch]), "text", 3))
    assert [x for p in parts for x in p.column("k").to_pylist()] == [1, 2, 3, 4, 5] and len(parts) > 1


# -- components and near-duplicates -----------------------------------------------------


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Stages(spark)).collect()}
    nodes = {x for p in links for x in p}
    want = joined(nodes, links)
    assert got == {k: v for k, v in want.items() if k != v}


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    k = 2048
    a, b = Counter(), Counter()
    for x in range(60):
        a[x], b[x] = int(rng.integers(0, 5)), int(rng.integers(0, 5))
    sets = [[(x, float(w)) for x, w in s.items() if w] for s in (a, b)]
    elem = np.array([x for s in sets for x, _ in s], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weight = np.array([w for s in sets for _, w in s])
    doc = np.repeat([0, 1], [len(s) for s in sets])
    sig = minhash.dart_signatures(elem, weight, doc, 2, k)
    want = sum((a & b).values()) / sum((a | b).values())
    assert abs((sig[0] == sig[1]).mean() - want) < 5 * np.sqrt(want * (1 - want) / k)
    # fractions of a unit: {x: 0.5} against {x: 1} is 0.5
    sig = minhash.dart_signatures(elem[[0, 0]], np.array([0.5, 1.0]), np.array([0, 1]), 2, k)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.06


def test_near_duplicates_match_all_pairs(spark, documents):
    rng = random.Random(1)
    rows = [(d, t) for d, t, _, _ in documents]
    base = next(t for _, t in rows if 100 < len(t.split()) < 200).split()
    for k in range(60):  # a dense group: copies with some words changed
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((100_000 + k, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Stages(spark)).collect()
    sets = {d: runs(t) for d, t in rows}
    links = []
    for (a, x), (b, y) in itertools.combinations([(d, s) for d, s in sets.items() if s], 2):
        low, total = sum((x & y).values()), sum(x.values()) + sum(y.values())
        if low / (total - low) >= 0.8:
            links.append((a, b))
    assert partition((r.doc_id, r.class_id) for r in got) == partition(joined(sets, links).items())


# -- decontamination --------------------------------------------------------------------


def closest(item, words):
    cost = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(cost[j] + 1, new[-1] + 1, cost[j - 1] + (x != y)))
        cost = new
    return min(cost)


def test_contaminated_matches_every_substring(spark, documents):
    rng = random.Random(5)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    tok = lambda t: re.findall(r"[^\W_]+", t.lower())
    rows = []
    for d, t, _, _ in documents[:60]:
        w = t.split()[:120]
        if d % 3 == 0:  # leaks with up to 0.2 word edits
            item = rng.choice(bench)[1].split()
            for _ in range(rng.randrange(0, int(0.2 * len(item)) + 1)):
                i = rng.randrange(len(item))
                item[i : i + rng.randrange(2)] = [f"edit{rng.randrange(1000)}"] * rng.randrange(2)
            w[60:60] = item
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench_rows = spark.createDataFrame(bench, "item_id long, text string")
    want = {}
    for d, t in rows:
        for i, x in bench:
            item, words = tok(x), tok(t)
            if len(set(item) & set(words)) >= 0.4 * len(set(item)):
                far = closest(item, words)
                if far <= int(0.2 * len(item)):
                    want[(d, i)] = far
    for size in (500_000, 100):  # one pass and many
        out = decontaminate.contaminated(docs, bench_rows, Stages(spark), words_per_pass=size).collect()
        assert {(r.doc_id, r.item_id): r.distance for r in out} == want
    assert len(want) >= 15


def test_walks_reach_the_recall():
    rng = np.random.default_rng(1)
    size, edits = 30, 6
    n = decontaminate.walks_needed(size, edits, 2, 0.99)
    strings = np.zeros((400, size + 1), dtype=np.uint64)
    strings[:, :-1] = rng.integers(1, 10**6, (400, size))
    other = decontaminate.edited(strings, edits, rng)
    walks = decontaminate.Walks(size, n, 2, seed=0)
    met = np.any([walks.keys(strings, w) == walks.keys(other, w) for w in range(n)], axis=0)
    assert met.mean() > 0.95


# -- tokens -------------------------------------------------------------------------------


def test_trie_counts_match_word_by_word(spark, documents):
    vocabulary = tokens.Vocabulary(tokens.load_pieces())
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in query(spark, "op3_token_counts").collect()}
    known = {}
    for d, t, _, _ in documents:
        words = re.findall("[^\x20\x09-\x0d]+", t)
        for w in words:
            if w not in known:
                known[w] = tokens.viterbi(tokens.WORD_START + w.encode(), vocabulary)
        assert got[d] == (len(words), sum(known[w] for w in words))


def test_viterbi_is_the_best_of_all_segmentations():
    rng = random.Random(2)
    pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 4))): -rng.uniform(1, 5) for _ in range(12)}
    vocabulary = tokens.Vocabulary(pieces)

    def best(word):
        if not word:
            return (0.0, 0)
        options = []
        for n in range(1, len(word) + 1):
            s = pieces.get(word[:n], vocabulary.byte if n == 1 else None)
            if s is not None:
                rest = best(word[n:])
                options.append((s + rest[0], 1 + rest[1]))
        return max(options, key=lambda x: x[0])

    words = sorted({bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 9))) for _ in range(60)})
    width = max(map(len, words))
    rows = np.array([list(w.ljust(width, b"\0")) for w in words], dtype=np.uint8)
    counts = tokens.trie_counts(rows, np.array([len(w) for w in words]), vocabulary)
    assert counts.tolist() == [best(w)[1] for w in words] == [tokens.viterbi(w, vocabulary) for w in words]


def test_cache_limit_changes_nothing(documents):
    vocabulary = tokens.Vocabulary(tokens.load_pieces())
    out = []
    for most in (1, 1 << 20):
        counter, hasher, total = tokens.Counter(vocabulary, most), Hasher(), []
        for _, t, _, _ in documents[:20]:
            w = split_words(pa.array([t]))
            total.append(int(counter.count(hasher.words(w.data, w.start, w.end), w.data, w.start, w.end).sum()))
        out.append(total)
    assert out[0] == out[1]


# -- quality ------------------------------------------------------------------------------


def brute_counts(t):
    w = re.findall("[^\x20\x09-\x0d]+", t or "")
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), dup, len(covered)


def test_base_rules(spark, documents):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: r for r in query(spark, "op4_quality_rules").collect()}
    assert len(got) == len(documents)
    for d, t, _, _ in documents:
        want = brute_counts(t)
        assert tuple(got[d][n] for n in names) == want
        assert got[d].base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (got[d].base_failed and got[d].kept)


def test_outlier_model_is_robust_and_right(spark):
    rng = np.random.default_rng(4)
    clean = rng.multivariate_normal([1.0, -2.0], [[1.0, 0.6], [0.6, 2.0]], 4000)
    junk = rng.normal([30.0, 30.0], 0.5, (1000, 2))
    rows = spark.createDataFrame([("en", "a", float(x), float(y)) for x, y in np.concatenate([clean, junk])], "g_lang string, g_source string, a double, b double")
    model = quality.outlier_model(rows, Stages(spark), {"a": 1e-3, "b": 1e-3}, 0.75, 6).first()
    assert np.allclose(model.mean, [1.0, -2.0], atol=0.15)
    scatter = np.linalg.inv(np.array(model.inverse).reshape(2, 2))
    # the closest three quarters of all rows are nearly all of the clean ones, so the scale is theirs
    assert np.allclose(scatter[0, 1] / np.sqrt(scatter[0, 0] * scatter[1, 1]), 0.6 / np.sqrt(2), atol=0.1)
    far = np.einsum("ij,jk,ik->i", junk - model.mean, np.linalg.inv(scatter), junk - model.mean)
    assert far.min() > quality.chi2_quantile(1 - 1e-6, 2)


def test_chi2_quantile():
    assert abs(quality.chi2_quantile(0.95, 7) - 14.067) < 0.05 and abs(quality.chi2_quantile(0.5, 5) - 4.351) < 0.03


def test_junk_goes_and_labelled_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.quality(docs, Stages(spark)).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in out if r.quality == 1]
    bad = [r.kept for r in out if r.quality == 0]
    assert all(good) and sum(bad) <= 0.2 * len(bad)


def test_junk_that_holds_a_third_of_a_source_goes(spark):
    rng = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "source", "text")
    lang, source, n = docs.groupBy("lang", "source").count().orderBy(F.desc("count"), "lang", "source").first()
    junk = " ".join(f"{rng.choice('#$%&')}{rng.choice('!?^~')}{rng.randrange(10**9)}{rng.choice('{}[]=')}" for _ in range(120))
    copies = spark.createDataFrame([(10**9 + k, lang, source, junk) for k in range(n // 2)], docs.schema)
    out = quality.quality(docs.unionByName(copies), Stages(spark)).where("not base_failed").collect()
    kept = [r.kept for r in out if r.doc_id >= 10**9]
    assert len(kept) == n // 2 and not any(kept)
    good = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()}
    assert all(r.kept for r in out if r.doc_id in good)


# -- lines ----------------------------------------------------------------------------------


def test_near_threshold_lines_are_counted_exactly(spark):
    rng = random.Random(0)
    rows, spread = [], {}
    for k in range(40):
        sites = rng.sample(range(60), 20 + k // 4)
        spread[f"line {k}"] = len(sites)
        rows += [(1000 * k + s, f"line {k}\nown {k} {s}", f"site{s}") for s in sites for _ in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = lines.boilerplate(docs, Stages(spark), min_sites=25).collect()
    assert len(first) == sum(n >= 25 for n in spread.values())


# -- personal data ----------------------------------------------------------------------------


def test_base_spans_match_a_search_of_the_whole_text(documents):
    patterns = {k: p.pattern.decode("latin1") for k, p in pii.BASE.items()}
    extra = ["+1 (569) 555-3296 4524132264652812 é a@b.c.d..e 1.2.3.4.5 999.1.1.1 +12 4 x", "4111 1111 1111 1111-4111-1111", "@@a@b.c%+-@x-y.z", "1.2.3.4@5.6.7.8"]
    for t in extra + [d[1] for d in documents]:
        texts = np.array([0, len(t.encode())])
        data = np.frombuffer(t.encode(), dtype=np.uint8)
        char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        got = [(pii.KINDS[k], int(char[a]), int(char[b])) for k, a, b in pii.base_spans(data, texts)]
        want = [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(patterns[k], t) if pii.holds(k, m[0].encode())]
        assert got == want


def test_tagger_gradients():
    tagger = pii.Tagger(seed=1)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    classes, tags = pii.labelled(["some words here and there to set things in"], 3, 1)
    classes, tags = classes[:, :12], tags[:, :12]
    _, grads = tagger.loss(classes, tags)
    rng = np.random.default_rng(0)
    for k, v in tagger.p.items():
        at = (int(classes[0, 0]), 1) if k == "embed" else tuple(int(rng.integers(n)) for n in v.shape)
        old, step = v[at], 1e-3
        v[at] = old + step
        up = tagger.loss(classes, tags)[0]
        v[at] = old - step
        down = tagger.loss(classes, tags)[0]
        v[at] = old
        assert abs((up - down) / (2 * step) - grads[k][at]) < 1e-3 + 0.01 * abs(grads[k][at]), k


def test_viterbi_decoding_is_the_best_path():
    tagger = pii.Tagger(seed=2)
    tagger.p["move"] = np.random.default_rng(0).normal(0, 1, tagger.p["move"].shape).astype(np.float32)
    classes = np.random.default_rng(1).integers(0, pii.CLASSES, (3, 4))
    e, got = tagger.emissions(classes), tagger.decode(classes)
    for r in range(3):
        score = lambda p: tagger.p["first"][p[0]] + sum(e[r, t, p[t]] for t in range(4)) + sum(tagger.p["move"][a, b] for a, b in zip(p, p[1:]))
        assert abs(score(tuple(got[r])) - max(map(score, itertools.product(range(pii.TAGS), repeat=4)))) < 1e-4


def test_tagger_learns_and_adds_what_patterns_miss(spark, documents):
    contexts = [x for _, t, _, _ in documents[:100] for x in re.split(r"\S*[0-9@]\S*", t[:2000]) if len(x) >= 40]
    tagger = pii.train(contexts)
    classes, tags = pii.labelled(contexts, 300, 99)
    got = tagger.decode(classes)
    assert (got[tags > 0] == tags[tags > 0]).mean() > 0.9 and (got[(tags == 0) & (classes > 0)] > 0).mean() < 0.02
    plain = " ".join(contexts[0].split()[:15])
    rows = [(k, f"{plain} ({200 + k}) 555-{1000 + 7 * k} {plain}") for k in range(40)]
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), tagger).collect()
    # ten digits without a plus: only the model finds them
    right = sum(any(s.startswith("phone:") and rows[r.doc_id][1][int(s.split(":")[1]) : int(s.split(":")[2])].strip("(").startswith(str(200 + r.doc_id)) for s in r.spans.split(",") if s) for r in out)
    assert sum(r.n_phone for r in out) == 0 and right >= 30


# -- paragraphs -----------------------------------------------------------------------------------


def test_repeated_passages_match_brute_force_over_words(spark, documents):
    rows = sorted((d, t) for d, t, _, _ in documents)
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"), Stages(spark)).collect()
    words = {d: t.lower().split() for d, t in rows}
    gone = {(r.doc_id, i) for r in got if r.removed for i in range(r.start_word, r.start_word + r.n_words)}
    whole = {}
    for d, w in words.items():
        for i in range(len(w)):
            whole.setdefault(tuple(w[i : i + 60]), d)
    # words of runs of 60 or more that an earlier document has too
    want = {
        (d, j)
        for d, w in words.items()
        for i in range(len(w) - 59)
        if whole[tuple(w[i : i + 60])] < d
        for j in range(i, i + 60)
    }
    assert len(want) > 1000 and len(want & gone) >= 0.98 * len(want)
    # what goes is, but for the edits allowed, a run of the earlier document named

    def edits(a, b):  # of a to its closest run in b
        cost = [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, cost[j] + 1, cost[j - 1] + (x != y)))
            cost = new
        return min(cost)

    for r in got:
        assert r.n_words >= paragraphs.MIN_SPAN
        if r.removed:
            own = words[r.doc_id][r.start_word : r.start_word + r.n_words]
            assert (r.first_doc, r.first_start) < (r.doc_id, r.start_word)
            assert edits(own, words[r.first_doc]) <= 0.25 * len(own)


@pytest.mark.parametrize("length,changes,least", [(60, 0, 0.98), (60, 1, 0.95), (120, 3, 0.98), (51, 0, 0.98)])
def test_whole_passages_are_reported(spark, length, changes, least):
    rng = random.Random(length + changes)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows, planted = [], {}
    for k in range(200):
        passage = text(length)
        for c in range(2):
            own = list(passage)
            for i in rng.sample(range(length), changes * c):
                own[i] = "changed"
            w = text(rng.randrange(100, 200))
            i = rng.randrange(len(w))
            rows.append((2 * k + c, " ".join(w[:i] + own + w[i:])))
            planted[2 * k + c] = (i, i + length)
    out = paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"), Stages(spark)).collect()
    inside, outside = Counter(), 0
    for r in out:
        a, b = planted[r.doc_id]
        assert r.removed == r.doc_id % 2
        n = max(0, min(b, r.start_word + r.n_words) - max(a, r.start_word))
        inside[r.doc_id] += n
        outside += r.n_words - n
    copies = {d: n for d, n in inside.items() if d % 2}
    assert len(copies) >= least * 200
    assert sum(copies.values()) >= 0.9 * length * 200
    assert outside <= 0.01 * sum(inside.values())


def test_one_copy_of_every_passage_stays(spark):
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passages = [text(rng.randrange(60, 200)) for _ in range(30)]
    rows = [(d, " ".join(text(20) + p + text(15) + q)) for d in range(90) for p, q in [rng.sample(passages, 2)]]
    rows += [(None, rows[0][1]), (7, rows[3][1])]  # no id; a second text under one id
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [r.text.split() for r in paragraphs.drop_repeats(docs, Stages(spark)).collect()]
    assert len(left) == len(rows)
    standing = Counter(tuple(w[i : i + 5]) for w in left for i in range(len(w) - 4))
    used = {tuple(p) for p in passages if sum(" ".join(p) in t for _, t in rows)}
    for p in used:
        seen = [standing[tuple(p[i : i + 5])] for i in range(len(p) - 4)]
        assert min(seen) >= 1 and sum(n == 1 for n in seen) >= 0.9 * len(seen)


def test_planted_passages_are_caught(spark, documents):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu") for b in ("ra", "si", "vo", "pel", "dun", "gor", "")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, planted = [], set()
    for k in range(40):
        passage = text(rng.randrange(60, 160)).split()
        for c in range(2):
            w = text(rng.randrange(150, 300)).split()
            i = rng.randrange(len(w))
            rows.append((2 * k + c, " ".join(w[:i] + passage + w[i:])))
        planted.add(2 * k + 1)
    clean = [(1000 + k, text(300)) for k in range(40)]
    out = paragraphs.repeated_paragraphs(spark.createDataFrame(rows + clean, "doc_id long, text string"), Stages(spark)).where("removed")
    hit = {r.doc_id for r in out.collect()}
    assert len(hit & planted) >= 0.9 * len(planted) and not hit & {d for d, _ in clean}


# -- mixing -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("slots", [{"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 333, "b": 333, "c": 334}, {"a": 999, "b": 1}, {"a": 5, "b": 11, "c": 13, "d": 71}])
def test_pfair_keeps_every_source_within_a_block(slots):
    order, period, served = mixing.pfair_period(slots), sum(slots.values()), Counter()
    for t, s in enumerate(order, 1):
        served[s] += 1
        assert all(abs(served[x] * period - slots[x] * t) < period for x in slots)
    assert served == slots


def test_mix_matches_a_simulated_schedule(spark, documents):
    docs = spark.createDataFrame([(d, t, s) for d, t, _, s in documents], "doc_id long, text string, source string")
    block, period = 4, 50
    weights = {s: 1.0 + k % 3 for k, s in enumerate(sorted({d[3] for d in documents}))}
    got = {r.mix_position: (r.doc_id, r.source) for r in mixing.mix(docs, Stages(spark), weights=weights, block=block, period=period).collect()}
    left = defaultdict(list)
    for d, _, _, s in sorted(documents, key=lambda r: r[0]):
        left[s].append(d)
    want = []
    while left:  # block by block: the next slot's source, until one runs out
        order = mixing.pfair_period(mixing.apportion({s: weights[s] for s in left}, period))
        for s in itertools.cycle(order):
            want += [(d, s) for d in left[s][:block]]
            left[s] = left[s][block:]
            if not left[s]:
                del left[s]
                break
    assert [got[k] for k in range(len(documents))] == want


def test_apportion():
    assert mixing.apportion({"a": 1.0, "b": 3.0}, 1000) == {"a": 250, "b": 750}
    slots = mixing.apportion({str(k): 0.0001 if k else 1.0 for k in range(30)}, 100)
    assert sum(slots.values()) == 100 and min(slots.values()) == 1


@pytest.mark.parametrize("sources", [20, 200])
def test_every_source_stays_within_a_block_of_its_exact_weight(sources):
    rows = [sources * 200] + [401 + 7 * k for k in range(sources - 1)]  # one source holds a third or more
    weights = {f"s{k}": n**0.5 for k, n in enumerate(rows)}
    weights["s1"] = 1e-5 * sum(weights.values())
    blocks, total = {f"s{k}": n for k, n in enumerate(rows)}, sum(weights.values())
    served, worst, n = Counter(), 0.0, 0
    for t, (s, j) in enumerate(mixing.schedule(blocks, weights), 1):
        assert j == served[s]
        served[s] += 1
        n += 1
        if worst is not None and t % 7 == 0:  # until the first source runs out, the target is w t
            worst = max(worst, *(abs(served[x] - w / total * t) for x, w in weights.items()))
        if served[s] == blocks[s]:
            assert worst is None or worst < 1 + 1e-6
            worst = None
    assert served == blocks and n == sum(rows)


def test_sources_that_run_out_leave_the_others_within_a_block():
    blocks, weights = {"a": 3, "b": 40, "c": 90, "d": 1}, {"a": 0.31, "b": 1 / 3, "c": 0.2, "d": 1e-3}
    served, fluid = Counter(), dict.fromkeys(blocks, 0.0)
    for s, _ in mixing.schedule(blocks, weights):
        served[s] += 1
        rest = 1.0  # of the slot, shared out until it is used up
        while rest > 1e-12 and (left := [x for x in blocks if fluid[x] < blocks[x] - 1e-9]):
            total = sum(weights[x] for x in left)
            step = min(rest, *[(blocks[x] - fluid[x]) * total / weights[x] for x in left])
            for x in left:
                fluid[x] += step * weights[x] / total
            rest -= step
        assert all(abs(served[x] - fluid[x]) < 1 + 1e-6 for x in blocks)
    assert served == blocks


def test_any_number_of_sources_is_mixed(spark):
    rows = [(k, f"text {k}", f"site{k % 700}" if k % 3 else "big") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.placed(docs, Stages(spark), block=4).collect()
    assert sorted(r.position for r in out) == list(range(len(rows)))
    assert {(r._src, r._id) for r in out} == {(s, d) for d, _, s in rows}
    order = defaultdict(list)
    for r in sorted(out, key=lambda r: r.position):
        order[r._src].append(r._id)
    assert len(order) == 701 and all(v == sorted(v) for v in order.values())


# -- chat ---------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r.conv_id].append((r.role, r.text or ""))
    convs[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in query(spark, "op9_chat_formatting").collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_escape_round_trip():
    rng = random.Random(1)
    parts = [*chat.CONTROLS, "\\", "\\a", "x", " ", "<", "[", "/"]
    for _ in range(500):
        turns = [(rng.choice(["user", "assistant", "system", "tool"]), "".join(rng.choices(parts, k=rng.randrange(8)))) for _ in range(rng.randrange(1, 6))]
        assert chat.read_back(chat.render(turns)) == turns
        x = chat.Located(turns, chat.render)
        assert x.formatted == chat.render(turns) and not x.rewritten
        assert [chat.unescape(x.formatted[a:b]) for a, b in x.loss] == [t for r, t in turns if r == "assistant"]
        assert "".join(x.formatted[a:b] for a, b in x.spans) == x.formatted


def test_long_conversations_use_the_window():
    turns = [("user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(100)]
    x = chat.Located(turns, chat.render, full=8)
    assert x.formatted == chat.render(turns)
    assert [x.formatted[a:b] for a, b in x.loss] == [t for r, t in turns if r == "assistant"]


def test_templates_that_rewrite_history_are_detected():
    def last_only(turns):  # hides all texts but the last, as templates that strip thoughts do
        return "".join(f"<{r}>{t if k == len(turns) - 1 else ''}</{r}>" for k, (r, t) in enumerate(turns))

    x = chat.Located([("user", "a"), ("assistant", "b"), ("user", "c")], last_only)
    assert x.rewritten == [1, 2] and x.formatted == last_only([("user", "a"), ("assistant", "b"), ("user", "c")])

    def counts(turns):
        return "".join(f"{len(turns)}{t};" for _, t in turns)

    assert chat.Located([("user", "a"), ("user", "b")], counts).rewritten == [1]

    def numbered(turns):
        return "".join(f"{k}{t};" for k, (_, t) in enumerate(turns))

    numbered.window = 0
    with pytest.raises(ValueError):
        chat.Located([("user", "a"), ("user", "b")], numbered)


@pytest.mark.parametrize("n", [41, 50, 64, 100])
def test_rewrites_that_begin_late_are_detected(n):
    def forgets(turns):  # drops all but the last 20 turns once there are more than 40
        return "".join(f"<{r}>{t}</{r}>" for r, t in (turns if len(turns) <= 40 else turns[-20:]))

    turns = [("user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(n)]
    whole = chat.Located(turns, forgets)
    assert whole.rewritten == list(range(40, n))
    forgets.window = 0
    x = chat.Located(turns, forgets)
    assert x.rewritten == whole.rewritten and x.formatted == forgets(turns) and x.spans == whole.spans and x.loss == whole.loss


# -- archives ---------------------------------------------------------------------------------------------


def test_bundles_are_plain_zstandard_and_seekable(spark, tmp_path):
    import zstandard

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    manifest = warc.write_archive(pages, Stages(spark), folder=str(tmp_path / "out"), frame_bytes=8000, bundle_bytes=30000)
    rows = manifest.collect()
    assert len({r.bundle for r in rows}) > 1 and any(r.frame > 0 for r in rows) and any(r.offset > 0 for r in rows)
    html = {r.page_id: r.html for r in pages.collect()}
    for bundle in {r.bundle for r in rows}:
        with open(bundle, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert [warc.page_of(head["WARC-Record-ID"]) for _, _, head, _ in warc.parsed(whole)] == [r.page_id for r in rows if r.bundle == bundle]
    some = spark.createDataFrame([(p,) for p in list(html)[::17]], "page_id long")
    found = warc.fetch(manifest, some).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in found} == {p: html[p] for p in list(html)[::17]}


def test_bundles_are_read_in_tasks_of_their_own(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    manifest = Stages(spark).cut(warc.write_archive(pages, Stages(spark), folder=str(tmp_path / "out"), frame_bytes=8000, bundle_bytes=30000), "manifest")
    bundles = {r.bundle for r in manifest.collect()}
    read = warc.read_archive(manifest).withColumn("task", F.spark_partition_id()).collect()
    assert len(bundles) > 1 and len({r.task for r in read}) == len(bundles)
    assert sorted(r.page_id for r in read) == sorted(r.page_id for r in manifest.collect())
