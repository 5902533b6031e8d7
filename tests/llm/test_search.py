"""Ranked search, sharding and spelling variants: brute force and edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from driftline.llm import ranking, sharding, spelling

COLUMNS = "doc_id long, text string, lang string, source string, shard int, slot string, word string, rank int"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "en" if k % 3 else None, f"s{k % 5}", 7, "x", "w", 1) for k, (i, t) in enumerate(rows)], COLUMNS)


# -- ranked search ---------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, top=10):
    held = [(i, Counter(t)) for i, t in ((i, plain_terms(t)) for i, t in docs) if t]
    total, n_docs = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def ranked_rows(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def search_corpus():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["Straße", "été", "漢字", "K9"]
    weights = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(1, 90))) for _ in range(150)]
    docs = [(k, t) for k, t in enumerate(texts)]
    docs += [(1000 + k, texts[0]) for k in range(40)]                     # ties
    docs += [(7, texts[7]), (7, texts[7]), (None, texts[0]), (None, texts[9])]  # repeated rows, null ids
    docs += [(2000, None), (2001, ""), (2002, ".,;\n\t"), (2003, "w3 " * 30_000), (2004, "ÄB äb W1")]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for k in range(25)]
    items += [(100, texts[0]), (101, "nowhere found"), (102, None), (103, "!!"), (104, "w0 w0 W0 w3")]
    return docs, items


def test_ranking_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 16)
    monkeypatch.setattr(ranking, "HEAD_ROWS", 20)
    docs, items = search_corpus()
    asked = spark.createDataFrame([(i, t, 3) for i, t in items] + [(None, "w1", 3)], "item_id long, text string, score int")
    want = plain_ranks(docs, items)
    assert ranked_rows(ranking.search(frame(spark, docs), asked)) == want
    assert ranked_rows(ranking.search(frame(spark, docs), asked, block_bytes=600)) == want  # several blocks of items


def test_ranking_prunes_buckets_and_documents():
    """Bounds cut work and not results: the same best rows as without any threshold."""
    rng = np.random.default_rng(8)
    about = ranking.Collection(3000, 3000 * 50, np.sort(rng.integers(1, 9000, 400))[::-1].copy())
    queries = ranking.Queries([1, 2, 3], [np.sort(rng.choice(400, 12, replace=False)) for _ in range(3)],
                              [rng.integers(1, 3, 12) for _ in range(3)])
    docs = []
    for i in range(3000):
        near = queries.at[i % 3][: 12 if i < 60 else 2]
        docs.append((i, 50, np.unique(np.concatenate([near, rng.choice(400, 8)]))))
    def run(search, some):
        ends = np.append(0, np.cumsum([len(t) for _, _, t in some]))
        term = np.concatenate([t for _, _, t in some])
        search.bucket(np.array([i for i, _, _ in some]), np.array([n for _, n, _ in some]), ends, term, np.ones(len(term), np.int64))
    search = ranking.Search(queries, about, 10, np.zeros(3, np.int64))
    for a in range(0, 3000, 100):
        run(search, docs[a:a + 100])
    plain = [ranking.Search(queries, about, 10, np.zeros(3, np.int64)) for _ in range(3000)]
    for q in range(3):
        found = []
        for one, doc in zip(plain, docs, strict=True):
            if q == 0:
                run(one, [doc])
            found += [(-int(s), int(i)) for s, i in zip(*one.best[q], strict=True)]
        assert sorted(found)[:10] == [(-int(s), int(i)) for s, i in zip(*search.best[q], strict=True)]
    assert search.filtered > 2 * search.rescored
    # a bucket of short vectors falls to Cauchy-Schwarz as a whole
    before = search.pruned
    run(search, [(9000, 5000, np.array([399]))])
    assert search.pruned == before + 3


def test_ranking_of_empty_tables(spark):
    docs, items = search_corpus()
    asked = spark.createDataFrame(items, "item_id long, text string")
    none = asked.where("false")
    assert ranking.search(frame(spark, docs), none).collect() == []
    assert ranking.search(frame(spark, docs).where("false"), asked).collect() == []
    assert ranking.search(frame(spark, [(1, None), (2, "...")]), asked).collect() == []


# -- sharding --------------------------------------------------------------------
def plain_tree(rows, shards, dims):
    """rows: (key per dimension, tie, row, size); the shard of every row."""
    out = {}

    def split(part, first, many):
        if many == 1 or not part:
            out.update({r[2]: first for r in part})
            return
        span = [max(r[0][d] for r in part) - min(r[0][d] for r in part) for d in range(dims)]
        axis = max(range(dims), key=lambda d: (span[d], -d))
        part = sorted(part, key=lambda r: (r[0][axis], r[1], r[2]))
        need, gone = sum(r[3] for r in part) * (many // 2) / many, 0
        for k, r in enumerate(part):
            if gone + r[3] >= need:
                k += (need - gone) * 2 >= r[3]
                break
            gone += r[3]
        split(part[:k], first, many // 2)
        split(part[k:], first + many // 2, many - many // 2)

    split(rows, 0, shards)
    return out


def shard_corpus():
    rng = random.Random(4)
    docs = [(k, "x" * rng.randint(0, 300) + f"é{k}") for k in range(300)]
    docs += [(400 + k, "the same text") for k in range(200)]   # a hot group of copies
    docs += [(5, "repeated row")] * 150 + [(None, "no id"), (None, None), (900, None), (901, "")]
    return docs


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_sharding_equals_a_plain_tree(spark, shards):
    docs = frame(spark, shard_corpus()).coalesce(2)
    got = sharding.assign(docs, shards, tolerance=0.0).collect()
    assert len(got) == 654
    # the same keys, from Spark's hashes; rows in the order of their numbers
    from pyspark.sql import functions as F
    dims = sharding.default_dimensions(docs)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.octet_length(text) + 1, F.array(*dims.values()), F.monotonically_increasing_id(),
                        F.shiftrightunsigned(F.xxhash64(F.xxhash64("doc_id"), F.xxhash64(text)), 2), F.crc32(text.cast("binary"))).collect()
    low = [min((r[2][d] for r in keyed if r[2][d] is not None), default=0.0) for d in range(len(dims))]
    high = [max((r[2][d] for r in keyed if r[2][d] is not None), default=0.0) for d in range(len(dims))]
    def position(v, d):
        if v is None:
            return 0
        return 1 + math.floor((v - low[d]) / ((high[d] - low[d]) or 1.0) * float(sharding.POSITIONS - 2))
    rows = [([position(v, d) for d, v in enumerate(r[2])], r[4], r[3], r[1]) for r in keyed]
    place = plain_tree(rows, shards, len(dims))
    want = Counter((str(r[0]), r[1], r[5], place[r[3]]) for r in keyed)
    assert Counter((str(r.doc_id), r["size"], r.text_crc32, r.shard) for r in got) == want
    assert all(r.text_crc32 in {zlib.crc32((t or "").encode()) for _, t in shard_corpus()} for r in got)
    by_shard = {s: sorted(r.slot for r in got if r.shard == s) for s in range(shards)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())


def test_sharding_is_near_equal_for_any_skew_and_target(spark):
    docs = frame(spark, shard_corpus())
    got = sharding.assign(docs, target_bytes=4000).groupBy("shard").agg({"size": "sum"}).collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == -(-sum(sizes) // 4000) and max(sizes) - min(sizes) < 2 * 305
    with pytest.raises(ValueError):
        sharding.assign(docs)
    with pytest.raises(ValueError):
        sharding.assign(docs, target_bytes=1)


def test_sharding_edge_cases(spark):
    assert sharding.assign(frame(spark, []), 16).collect() == []
    few = sharding.assign(frame(spark, [(1, "a"), (1, "a"), (2, "a" * 100_000)]), 16).collect()
    assert len(few) == 3 and {r.shard for r in few} <= set(range(16))
    plain = spark.createDataFrame([(k, "t" * k) for k in range(50)], "doc_id long, text string")  # no metadata at all
    assert sharding.assign(plain, 4).count() == 50


# -- spelling --------------------------------------------------------------------
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(docs):
    n = Counter()
    for i, t in docs:
        for run in RUN.findall(t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(n, ratio=5):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= ratio * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def variant_rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def spelling_corpus():
    rng = random.Random(6)
    stems = ["".join(rng.choices("abcdeéß", k=rng.randint(6, 9))) for _ in range(25)]
    docs = []
    for k in range(120):
        words = []
        for _ in range(40):
            w = rng.choice(stems[: 1 + k % 25])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "x" + w[at:], w[:at] + "É" + w[at + 1:]])
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        docs.append((k, " ".join(words) + " 12 x÷y×zzzzzz"))
    docs += [(k, "chains " * 400 + "chainz " * 60 + "chainzz " * 8) for k in (500, 501)]  # forms of forms
    docs += [(None, "nameless nameless nameless nameless nameless"), (600, None), (601, ""), (602, "1234 ,"),
             (603, ("q" * 30_000 + " ") * 6 + ("q" * 30_001 + " ") * 30)]
    return docs + docs[:3]


def test_spelling_equals_brute_force(spark):
    docs = spelling_corpus()
    found = spelling.runs(frame(spark, docs))
    words = spelling.vocabulary(found.select(spelling.typed(found.run, found.doc_id).alias("word")))
    n = plain_words(docs)
    assert {r.word: r.n for r in words.collect()} == n
    want = plain_variants(n)
    assert variant_rows(spelling.group_variants(words)) == want
    assert any(r[1] and r[1] != r[2] for r in want)  # a chain of two forms
    assert variant_rows(spelling.group_variants(words, symbols=2)) == want  # many collisions, the same result


def test_neighbourhood_holds_every_edit():
    rng = random.Random(9)
    for _ in range(60):
        w = "".join(rng.choices("abcdefghié", k=rng.randint(1, 8)))
        own, around = spelling.neighbourhood(w)
        assert own in around
        for at in range(len(w)):
            for v in (w[:at] + w[at + 1:], w[:at] + "k" + w[at + 1:], w[:at] + "ÿ" + w[at:], w + "a"):
                assert spelling.neighbourhood(v)[0] in around


def test_spelling_of_empty_tables(spark):
    for docs in ([], [(1, None), (2, "a b c")]):
        found = spelling.runs(frame(spark, docs))
        words = spelling.vocabulary(found.select(spelling.typed(found.run, found.doc_id).alias("word")))
        assert spelling.group_variants(words).collect() == []
