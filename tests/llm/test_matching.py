"""SimHash groups, order MinHash, licences, contamination: brute force and edge cases."""

import re
import struct
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from driftline.llm import contamination, licences, orderhash, simhash
from driftline.llm.common import table
from tests.conftest import SF_SMALL

COLUMNS = "doc_id long, text string, fp long, cell string, signature string, item_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "c", "s", 2) for i, t in rows], COLUMNS)


def plain_simhash(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_groups(ids, prints, bits):
    group = {i: i for i in range(len(ids))}
    for a, b in combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits and group[a] != group[b]:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {k: new if v == old else v for k, v in group.items()}
    least = {}
    for k, g in group.items():
        if ids[k] is not None:
            least[g] = min(least.get(g, ids[k]), ids[k])
    return [least.get(group[k]) for k in range(len(ids))]


def test_simhash_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART_ROWS", 8)  # cells are split into parts
    words = [f"w{k}" for k in range(40)]
    rng = np.random.default_rng(5)
    base = [list(rng.choice(words, 60)) for _ in range(6)]
    rows = [(100 + k, " ".join(b)) for k, b in enumerate(base)]
    for k in range(60):  # near copies, chained
        b = base[k % 6] = list(base[k % 6])
        b[int(rng.integers(60))] = f"x{k}"
        rows.append((50 - k, " ".join(b)))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (None, "lonely words without an id"), (1003, "ÄB cd"), (1004, "äb CD"),
             (1005, "Äb Cd"), (1005, "Äb Cd"), (1006, "a " * 70_000)]
    got = simhash.near_duplicates(frame(spark, rows), 4, 4).collect()
    assert sorted(((r.doc_id is None, r.doc_id), r.fp % 2**64) for r in got) == sorted(((i is None, i), plain_simhash(t)) for i, t in rows)
    prints = [plain_simhash(t) for _, t in rows]
    want = dict(zip([i for i, _ in rows], plain_groups([i for i, _ in rows], prints, 4), strict=True))
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(frame(spark, rows), 4, 4)
    assert kept.columns == frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if c == i} | {None}


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_popcount_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    width = 64 // simhash.SEGMENTS
    for _ in range(200):
        a, b = (int(x) for x in rng.integers(0, 2**63, 2))
        counts = [[(x >> s * width & (1 << width) - 1).bit_count() for s in range(simhash.SEGMENTS)] for x in (a, b)]
        assert sum(abs(p - q) for p, q in zip(*counts, strict=True)) <= (a ^ b).bit_count()


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200 + k, 200 + (k + 1) % 7) for k in range(7)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 160))
    assert all(got[200 + k] == 200 for k in range(7))


def chained(values):
    seed = 42
    for v in values:
        seed = xxh64_intdigest(struct.pack("<Q", v % 2**64), seed)
    return seed


def plain_units(text):
    """Words, or the characters of a text of few words."""
    words = re.split(r"[\x20\x09-\x0D]+", text.strip(" "))
    return words if len(words) > orderhash.FEW else list(text)


def plain_signature(text):
    if not text:
        return [orderhash.EMPTY] * orderhash.BINS
    w = [xxh64_intdigest(x.encode(), 42) for x in plain_units(text)]
    seen, bins = {}, {}
    for place in range(max(1, len(w) - orderhash.WORDS + 1)):
        h = chained(w[place:place + orderhash.WORDS])
        seen[h] = seen.get(h, -1) + 1
        g = xxh64_intdigest(struct.pack("<i", seen[h]), chained([h]))
        bins.setdefault(g >> 64 - orderhash.BIN_BITS, []).append((g - 2**64 if g >> 63 else g, place))
    out = []
    for b in range(orderhash.BINS):
        least = sorted(sorted(bins.get(b, []))[:orderhash.KEPT], key=lambda x: x[1])
        out.append(max(1, chained([g for g, _ in least]) & 0x7FFFFFFF) if least else orderhash.EMPTY)
    return out


def test_order_minhash_equals_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").limit(40)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(900, None), (901, ""), (902, "one"), (903, "a b a b a b a b a b"), (None, "no id")]
    got = orderhash.fingerprint(frame(spark, rows)).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: "".join(f"{x:08X}" for x in plain_signature(t)) for i, t in rows}


def test_order_minhash_sees_order():
    words = [f"w{k}" for k in range(300)]
    a, same = plain_signature(" ".join(words)), plain_signature(" ".join(words[150:] + words[:150]))
    assert 0.3 < np.mean([x == y for x, y in zip(a, same, strict=True)]) < 1


def plain_full_signature(text):
    w = [xxh64_intdigest(x.encode(), 42) for x in plain_units(text)]
    seen, ring = {}, []
    for place in range(max(1, len(w) - orderhash.WORDS + 1)):
        h = chained(w[place:place + orderhash.WORDS])
        seen[h] = seen.get(h, -1) + 1
        ring.append((xxh64_intdigest(struct.pack("<i", seen[h]), chained([h])), place))
    out = []
    for b in range(orderhash.BINS):
        first = b << 64 - orderhash.BIN_BITS
        least = sorted(sorted(ring, key=lambda x: (x[0] - first) % 2**64)[:orderhash.KEPT], key=lambda x: x[1])  # noqa: B023
        out.append(max(1, chained([g - 2**64 if g >> 63 else g for g, _ in least]) & 0x7FFFFFFF))
    return out


def test_short_texts_show_their_order(spark):
    texts = ["one", "a b c d", "a b a b a b a b a b", " ".join(f"v{k}" for k in range(700))]
    for n in (20, 40, 60):
        words = [f"w{n}x{k}" for k in range(n)]
        texts += [" ".join(words), " ".join(words[n // 2:] + words[:n // 2])]
    got = [r.fingerprint for r in orderhash.fingerprint_edits(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()]
    assert got == ["".join(f"{x:08X}" for x in plain_full_signature(t)) for t in texts]
    near = {r.doc_id: r.near_next for r in orderhash.fingerprint_edits(frame(spark, list(enumerate(texts)))).collect()}
    assert all(near[k] < 0.7 for k in (4, 6, 8))  # moved halves: the sets of k-mers are nearly equal


def test_blocks_are_those_of_a_binary_search(spark):
    from bisect import bisect_right
    for bounds in ([], [5], [3, 10, 11], list(range(0, 900, 7))):
        got = spark.range(-3, 950, 13).selectExpr("id").union(spark.createDataFrame([(None,)], "id long"))
        rows = got.select("id", orderhash.block_of(got["id"], bounds).alias("b")).collect()
        assert all(r.b == (0 if r.id is None else bisect_right(bounds, r.id)) for r in rows)


def test_next_document_and_edits(spark):
    rows = [(5, "abcdefgh"), (1, "ÄÖÜ ßß\U0001f600xy"), (9, "x"), (None, "first of all"), (7, None), (3, "")]
    got = {r.doc_id: r for r in orderhash.fingerprint_edits(frame(spark, rows)).collect()}
    import hashlib
    order = [None, 1, 3, 5, 7, 9]
    text = {i: t or "" for i, t in rows}
    for k, i in enumerate(order):
        t, n = text[i], text[order[(k + 1) % len(order)]]
        e = len(t) // 4
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - e] + n[:e]).encode()).hexdigest()
    assert got[3].near_edited == got[3].near_next + 1 - got[3].near_next == 1
    one = orderhash.fingerprint_edits(frame(spark, [(4, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert orderhash.fingerprint_edits(frame(spark, rows).limit(0)).count() == 0


def test_licences(spark):
    rows = [(1, "Text.\nReleased under the MIT License.\nMore."), (2, "RELEASED  under the MIT license!"), (3, None), (4, ""),
            (5, "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without\nrestriction, including without limitation "
                "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or\nsell copies of the Software, and to "
                "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nother"),
            (6, "mit"), (7, "word " * 50_000), (None, "All rights reserved."), (2, "RELEASED  under the MIT license!")]
    got = sorted((r.doc_id or 0, r.line, r.lines, r.licence, round(r.dice, 3)) for r in licences.scan(frame(spark, rows), licences.notices(spark)).collect())
    assert got == [(0, 0, 1, "all-rights-reserved", 1.0), (1, 0, 3, "mit", 0.8), (1, 1, 1, "mit", 1.0), (2, 0, 1, "mit", 1.0), (2, 0, 1, "mit", 1.0),
                   (5, 0, 4, "mit-permission", 1.0)]
    many = licences.NOTICES * 2 + [(f"other-{k}", f"{k} some other wording number {k} of no document") for k in range(150)]
    named = frame(spark, rows).selectExpr("doc_id", "text", "'x' AS line", "1 AS licence", "2 AS dice")
    more = licences.scan(named, spark.createDataFrame(many, "licence string, text string"))
    assert got == sorted((r.doc_id or 0, r.line, r.lines, r.licence, round(r.dice, 3)) for r in more.collect())
    assert licences.scan(frame(spark, rows), licences.notices(spark).limit(0)).count() == 0
    assert licences.scan(frame(spark, rows).limit(0), licences.notices(spark)).count() == 0


def test_licences_inside_other_text(spark):
    header = licences.NOTICES[2][1].replace(" file except", "\n# file except").replace(" copy of", "\n# copy of")
    rows = [(1, "Copyright 2020 Acme Corp. All rights reserved."), (2, "Licensed under the MIT License."),
            (3, "intro\n\nThis work is licensed under CC BY 4.0."), (4, "# " + header + "\nimport os, sys\nprint(os.getcwd())\nx = 1 + 2 + 3 + 4 + 5 + 6 + 7 + 8 + 9 + 10 + 11 + 12 + 13\n"
            "for a, b, c in zip(p, q, r): yield from run(a, b, c, deep=True, fast=False, more=None)"),
            (5, "Released under the MIT License. All rights reserved."), (6, "All rights of way are reserved.")]
    got = sorted((r.doc_id, r.line, r.lines, r.licence, round(r.dice, 3)) for r in licences.scan(frame(spark, rows), licences.wider(spark)).collect())
    assert got == [(1, 0, 1, "all-rights-reserved", 1.0), (2, 0, 1, "mit", 1.0), (3, 2, 1, "cc-by-4.0", 1.0), (4, 0, 3, "apache-2.0-header", 1.0),
                   (5, 0, 1, "all-rights-reserved", 1.0), (5, 0, 1, "mit", 1.0)]


def plain_licences(text, templates, threshold=licences.THRESHOLD):
    """(line, lines, licence, dice) of one text, every template against every unit and every window."""
    def pairs(words):
        return list(zip(words, words[1:]))

    def dice(a, b):
        return 2 * len(a & b) / (len(a) + len(b))

    def apart(found):
        kept = []
        for x in sorted(found):
            if all(x[4] < y[3] or y[4] < x[3] for y in kept):
                kept.append(x)
        return kept

    known = sorted({(name, frozenset(pairs(re.findall("[a-z0-9]+", t.lower())))) for name, t in templates})
    lines = [re.findall("[a-z0-9]+", x.lower()) for x in (text or "").split("\n")]
    paragraphs, run = [], []
    for k, w in enumerate([*lines, []]):
        if w:
            run.append(k)
        elif run:
            paragraphs, run = [*paragraphs, run], []
    whole = []
    for unit in [[k] for k in range(len(lines))] + [p for p in paragraphs if len(p) > 1]:
        own = set(pairs([w for k in unit for w in lines[k]]))
        if own:
            best = min((-dice(own, b), name) for name, b in known)
            if -best[0] >= threshold - 1e-9:
                whole.append((unit[0], len(unit), best[1], -best[0]))
    inside = set()
    for p in paragraphs:
        at = [k for k in p for _ in lines[k]]
        row, found = pairs([w for k in p for w in lines[k]]), []
        for name, b in known:
            longest, reached = len(b) * (2 - threshold) / threshold + 1e-9, []
            for i in range(len(row)):
                ends = [j for j in range(i, len(row)) if j - i < longest and row[i] in b and row[j] in b]
                if ends:
                    both = {j: set(row[i:j + 1]) for j in ends}
                    best = min((-dice(both[j], b), -len(both[j] & b), name, i, j) for j in ends)
                    reached += [best] if -best[0] >= threshold - 1e-9 else []
            found += [(fewer, less, *rest) for less, fewer, *rest in apart(reached)]
        for _, less, name, i, j in apart(found):
            line, n = at[i], at[j + 1] - at[i] + 1
            if not any(u[2] == name and u[0] <= line and u[0] + u[1] >= line + n for u in whole):
                inside.add((line, n, name, -less))
    return whole + sorted(inside)


def test_licences_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    short = [(f"t{k}", " ".join(rng.choice(list("abcdef"), rng.integers(2, 9)))) for k in range(7)]
    wordings = licences.NOTICES + licences.VARIANTS
    rows = []
    for k in range(320):
        source, filler, loss = (short, "abcdefg", 0.05) if k < 200 else (wordings, ["filler"], 0.03)
        words = []
        for at in rng.integers(0, len(source), rng.integers(0, 5)):
            words += [*rng.choice(list(filler), rng.integers(0, 4)), *(w for w in source[at][1].split() if rng.random() >= loss)]
        rows.append((k, "".join(w + rng.choice([" ", ", ", "\n", "\n\n"], p=[0.8, 0.1, 0.07, 0.03]) for w in words)))
    for templates in (short, wordings):
        got = licences.scan(frame(spark, rows), spark.createDataFrame(templates, "licence string, text string")).collect()
        want = [(k, *x) for k, text in rows for x in plain_licences(text, templates)]
        assert len(want) > 100 and any(x[4] < 1 for x in want)
        assert sorted((r.doc_id, r.line, r.lines, r.licence, round(r.dice, 9)) for r in got) == sorted((*x[:4], round(x[4], 9)) for x in want)


def grams(text):
    return contamination.shingles(contamination.normal(text or "").split())


def test_contamination_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(500)]

    def prose(n):
        return " ".join(rng.choice(words, n))

    items = [(k, prose(int(n))) for k, n in enumerate(rng.integers(8, 130, 30))] + [(90, None), (91, ""), (92, "short one"), (0, "extra text " + prose(20))]
    rows = []
    for k, (_, text) in enumerate(items[:30]):
        w = text.split()
        cut = w[:len(w) // 2] + prose(400).split() + w[len(w) // 2:]  # in two pieces, far apart
        part = w[:max(6, int(len(w) * rng.uniform(0.6, 1)))]
        rows += [(10 * k, prose(3000) + " " + text.upper() + "! " + prose(2500)), (10 * k + 1, prose(50) + " " + " ".join(cut)),
                 (10 * k + 2, prose(700) + " " + " ".join(part) + " " + prose(5)), (10 * k + 3, prose(300))]
    rows += [(None, items[3][1]), (777, None), (778, ""), (779, "Short, one"), (10, prose(10)), (780, prose(40_000) + " " + items[5][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id, r.n_common) for r in contamination.find_leaks(frame(spark, rows), bench).collect()}
    want = {}
    for i, t in rows:
        own = grams(t)
        for j, u in items:
            q = grams(u)
            if q and len(q & own) >= 0.8 * len(q) - 1e-9:
                want[i, j] = max(want.get((i, j), (0, 0)), (len(q & own) / len(q), len(q & own)))
    assert got == {(*k, n) for k, (_, n) in want.items()}
    assert len(got) > 60
    kept = contamination.without_leaks(frame(spark, rows), bench)
    assert kept.columns == frame(spark, rows).columns
    assert kept.count() == sum(all(not (q := grams(u)) or len(q & grams(t)) < 0.8 * len(q) - 1e-9 for _, u in items) for _, t in rows)
    assert contamination.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0
    assert contamination.find_leaks(frame(spark, rows).limit(0), bench).count() == 0
    blocks = list(contamination.blocks(bench, block_items=10))
    assert len(blocks) > 1 and sum(len(b.ids) for b in blocks) == 33


def test_keep_one_among_rows_without_ids(spark):
    """Null-id copies go where the group has an id, else all but one of them."""
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(None, a), (None, a), (None, a), (None, b), (7, b), (3, "something else entirely that stands alone here")]
    kept = simhash.keep_one(frame(spark, rows), 4, 4).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept) == sorted(
        [(True, 0, a), (False, 7, b), (False, 3, rows[5][1])])


def test_short_items_are_never_missed(spark):
    """Items of one to four shingles at any place of a long text."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choice(words, 5 + k % 4))) for k in range(400)]
    block = contamination.build([i for i, _ in items], [t for _, t in items])
    powers = contamination.Powers()
    missed = 0
    for k, (_, t) in enumerate(items):
        filler = list(rng.choice(words, 300))
        at = int(rng.integers(0, 300))
        text = " ".join(filler[:at] + [t] + filler[at:])
        found = {i for i, _ in contamination.matches(text, block, powers, 0.8)}
        missed += k not in found
    assert missed == 0


def test_order_minhash_of_texts_without_blanks(spark):
    """Likeness follows the edits for scripts without blanks and for a few words."""
    long_text = "我们今天去公园散步然后回家吃饭晚上一起看电影明天早上再去学校上课下午踢足球"
    rows = [(1, long_text), (2, long_text[:-1] + "球场"), (3, "完全不同的内容与前面没有关系的另外一段文字说明"), (4, " \t\n"), (5, ""), (6, None)]
    text = F.coalesce("text", F.lit(""))
    sig = {r.doc_id: r.signature for r in frame(spark, rows).select("doc_id", orderhash.full_signature(text).alias("signature")).collect()}
    share = lambda a, b: sum(x == y for x, y in zip(sig[a], sig[b], strict=True)) / len(sig[a])
    assert share(1, 2) > 0.6 and share(1, 3) < 0.2
    assert any(sig[4]) and not any(sig[5]) and not any(sig[6])
