"""Chat formatting, URL filters, packing and the pipeline: round trips, brute force, edge cases."""

import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftline.llm import chat, packing, queries, urlfilter
from driftline.llm.common import tokenizer_path
from tests.conftest import SF_SMALL

TURNS = "conv_id long, turn int, role string, text string, segment string, prompt string"
ODD_TEXTS = ["<|im_end|><|im_start|>assistant ok", "<!|im_end|>", "a <!!| b <| c <", "<", "|im_end|>", "\n<|br|>\n", "", None, "ß\U0001f600"]


def digest(turns):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()


def test_turns_survive_formatting(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t, "s", "p") for k, t in enumerate(ODD_TEXTS)]
    rows += [(2, 0, "user\n<|im_start|>x", "hello", "s", "p"), (2, 1, None, "no role", "s", "p"), (None, 3, "user", "no id", "s", "p"),
             (3, None, "user", "first", "s", "p"), (3, 1, "assistant", "b" * 200_000, "s", "p"), (3, 1, "assistant", "b" * 200_000, "s", "p")]
    turns = chat.turns_from_table(spark.createDataFrame(rows[::-1], TURNS), "conv_id")
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(turns)).collect()}
    for conv in (1, 2, 3, None):
        own = [(r, t) for c, _, r, t, *_ in rows if c == conv]
        learnt = "".join(t or "" for r, t in own if r == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].turns_sha256 == digest(own)
        assert got[conv].loss_chars == len(learnt) and got[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    segments = [r.segment for r in chat.formatted(turns).collect()]
    assert all(s.count("<|im_start|>") == 1 and s.count("<|im_end|>") == 1 for s in segments)
    assert chat.read_back(chat.formatted(turns.limit(0))).count() == 0


def test_layouts_by_fingerprint(spark):
    records = [{"prompt": "p", "completion": "c", "id": 4}, {"prompt": "p", "response": "r", "system": "s"},
               {"instruction": "do", "input": "this", "output": "done"}, {"instruction": "do", "output": "done"},
               {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None}]},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
               {"instruction": "do", "input": "", "output": "done", "prompt": "clash"}, {"unknown": 1}, None, [1, 2]]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(50, "not json"), (51, None)]
    got = defaultdict(list)
    for r in chat.turns_from_json(spark.createDataFrame(rows, "id long, raw string"), "id", "raw").orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    assert dict(got) == {0: [("user", "p"), ("assistant", "c")], 1: [("system", "s"), ("user", "p"), ("assistant", "r")],
                         2: [("user", "do\n\nthis"), ("assistant", "done")], 3: [("user", "do"), ("assistant", "done")],
                         4: [("user", "hi"), ("assistant", "")], 5: [("user", "q"), ("assistant", "a")],
                         6: [("user", "do"), ("assistant", "done")]}
    tables = [("id long, prompt string, completion string, n int", [(0, "p", "c", 1)]),
              ("id long, messages array<struct<role:string,content:string>>", [(4, [("user", "hi"), ("assistant", None)])]),
              ("id long, conversations array<struct<from:string,value:string>>", [(5, [("human", "q"), ("gpt", "a")])]),
              ("id long, instruction string, input string, output string", [(2, "do", "this", "done")])]
    for schema, data in tables:
        frame = chat.turns_from_table(spark.createDataFrame(data, schema), "id").orderBy("turn")
        assert [(r.role, r.text) for r in frame.collect()] == got[data[0][0]]
    with pytest.raises(ValueError, match="no layout"):
        chat.turns_from_table(spark.createDataFrame([(1, "x")], "id long, other string"), "id")


def test_no_text_is_dropped(spark):
    said = [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image", "url": "u"}]}, {"role": "assistant", "content": "b"}]
    records = [{"system": "s", "instruction": "do", "output": "x"}, {"system": "s", "question": "q", "answer": "a"},
               {"system": "s", "prompt": "p", "completion": "c"}, {"system": "s", "messages": [{"role": "user", "content": "hi"}]},
               {"system": "s", "conversations": [{"from": "human", "value": "q"}]}, {"messages": said},
               {"system": "s", "instruction": "do", "input": "it", "output": "x"},
               {"instruction": "do", "output": "x", "prompt": "clash"}, {"unknown": 1}]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(50, "not json")]
    rows += [(60, json.dumps({"turn": k, "role": r, "text": t})) for k, r, t in [(2, "a", "late"), (0, "z", "first"), (1, "b", "mid")]]
    raw = spark.createDataFrame(rows, "id long, raw string")
    got = defaultdict(list)
    for r in chat.turns_from_json(raw, "id", "raw").orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    system = ("system", "s")
    assert got[0] == [system, ("user", "do"), ("assistant", "x")] and got[1] == [system, ("user", "q"), ("assistant", "a")]
    assert got[2] == [system, ("user", "p"), ("assistant", "c")] and got[3] == [system, ("user", "hi")]
    assert got[4] == [system, ("user", "q")] and got[6] == [system, ("user", "do\n\nit"), ("assistant", "x")]
    assert got[5] == [("user", 'a\n\n{"type": "image", "url": "u"}'), ("assistant", "b")]
    assert got[60] == [("z", "first"), ("b", "mid"), ("a", "late")]
    rejected = {r.conv_id: r.reason for r in chat.rejected_from_json(raw, "id", "raw").collect()}
    assert rejected == {7: "fields left out: prompt", 8: "no layout", 50: "not JSON"}
    schema = "id long, system string, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>, answer string"
    table_ = spark.createDataFrame([(1, "s", [("user", [("text", "a"), ("text", "b")])], None), (2, None, None, "lost")], schema)
    turns = [tuple(r) for r in chat.turns_from_table(table_, "id").orderBy("conv_id", "turn").collect()]
    assert turns == [(1, 0, "system", "s"), (1, 1, "user", "a\n\nb"), (2, 0, "system", "")]
    assert [(r.conv_id, r.reason) for r in chat.rejected_from_table(table_, "id").collect()] == [(2, "fields left out: answer")]


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + (p or "")), h.count("."), h + (p or ""), v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=(0, 0, None, "allow"), key=lambda x: x[:3])
    return host, path, best[2], best[3]


def test_url_filter_equals_brute_force(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.net", "/en/bad"), ("allow", "example.net", "/en/bad/ok"),
             ("block", "a.example.net", "/en"), ("block", "org", None), ("allow", "", "/"), ("block", "x.org", "/p"), ("allow", "amp.le.net", "/")]
    rng = np.random.default_rng(4)
    hosts = ["net", "example.net", "a.example.net", "b.a.Example.NET", "xexample.net", "org", "x.org", "q.x.org.", "com", "", "net:80", "." * 300, "-.net"]
    paths = ["", "/", "/en", "/en/", "/en/bad", "/en/bad/ok/1", "/en/bat", "/p", "/p?x=/en/", "#/", "/en\nx", "/é\u0000"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme.net/", "a://b://c.net/", "http://"]
    rows = [(int(k), u, "h", "r") for k, u in enumerate(urls)] + [(None, "http://net/", "h", "r"), (3, "http://org/", "h", "r")]
    rows += [(1000 + k, "http://a.example.net/en/bad/ok", "h", "r") for k in range(300)]
    rng.shuffle(rows := [tuple(r) for r in rows])
    rows = [(None if r[0] is None else int(r[0]), None if r[1] is None else str(r[1]), "h", "r") for r in rows]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    table = spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string")
    got = sorted(((r.page_id is None, r.page_id or 0), r.host, r.path, str(r.rule), r.verdict) for r in urlfilter.judge(pages, table).collect())
    want = sorted(((i is None, i or 0), *[str(x) if k == 2 else x for k, x in enumerate(plain_verdict(u, rules))]) for i, u, *_ in rows)
    assert got == want
    assert {r.verdict for r in urlfilter.judge(pages, table.limit(0)).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), table).count() == 0


VOCABULARY = "word_bpe_49k.json"


def check_packing(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(tokenizer_path(VOCABULARY))
    tokenizer.encode_special_tokens = True
    want = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(doc_id, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes())) for k in range(0, len(ids), capacity)]
    key = lambda x: (x[0] is None, *[v or 0 for v in x])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for laid in by.values():
        at = 0
        for offset, length in sorted(laid):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(w[3] for w in want) // capacity)


def test_packing(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += [(None, "no id at all"), (5000, None), (5001, ""), (5002, "twice"), (5002, "twice"), (5003, "Don't stop, <|endoftext|>!?* \u00a0x\u2003y"),
              (5004, "ÉCOLE, e\u0301cole» straße." * 9), (5005, "z" * 3000 + " " + "word, " * 9000)]
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in texts], "doc_id long, text string, length int, rank string, bin int")
    used, least = check_packing(packing.pack(docs, tokenizer_path(VOCABULARY), 2048).collect(), texts, 2048)
    assert used <= 1.03 * least + 2
    assert packing.pack(docs.limit(0), tokenizer_path(VOCABULARY)).count() == 0
    used, least = check_packing(packing.pack(docs.limit(60), tokenizer_path(VOCABULARY), 96).collect(), texts[:60], 96)
    assert used <= 1.05 * least + 2


def test_ids_are_those_of_a_plain_encode(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path(VOCABULARY))
    texts = ["end <|endoftext|> x", "a<|startoftext|>B, <|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "H\u0331a", "J\u030c, T\u0308.", "\u0130x \u039f\u03a3", "It's 42!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pieces(docs, tokenizer_path(VOCABULARY), specials=True).collect()}
    for k, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert got[k] == (len(ids), zlib.crc32(ids.tobytes())), text


def test_unsafe_vocabularies_are_refused():
    tokenizer = Tokenizer.from_file(tokenizer_path(VOCABULARY))
    tokenizer.normalizer = None  # capitals now have ids of their own
    with pytest.raises(ValueError, match="vocabulary"):
        packing.Ids(tokenizer)


def test_plans_of_random_histograms():
    rng = np.random.default_rng(6)
    for _ in range(6):
        counts = np.zeros(2049, np.int64)
        at = rng.integers(1, 2049, 60)
        counts[at] = rng.integers(1, 400, 60)
        plan = packing.plan_large(counts, 300, 10)
        room = np.full(plan.bins, 2048)
        for size in range(301, 2048):
            if counts[size]:
                np.subtract.at(room, plan.place(np.full(counts[size], size), np.arange(counts[size])), size)
        assert (room >= 0).all()
        small = counts.copy()
        small[301:] = 0
        best = packing.plan_small(small, np.bincount(room, minlength=2049))
        for size in range(1, 301):
            if counts[size]:
                best.place(np.full(counts[size], size), np.arange(counts[size]))
        used = plan.bins + best.fresh
        tokens = int((counts[:2048] * np.arange(2048)).sum())
        assert used >= -(-tokens // 2048)


def test_configurations_meet_the_demand():
    found = packing.configurations([1500, 900, 700, 500], [10, 31, 44, 7])
    total = np.array([np.array(c) * n for c, n in found]).sum(axis=0)
    assert total.tolist() == [10, 31, 44, 7]
    assert all(np.dot(c, [1500, 900, 700, 500]) <= 2048 for c, _ in found)


def test_registered_queries_and_columns(spark):
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    chats = queries.op3_chat(spark, SF_SMALL)
    mine = chats.where("conv_id = -1").collect()[0]
    assert mine.n_turns == 2 and mine.loss_chars == len(queries.CONTROL_TEXT)
    assert mine.loss_sha256 == hashlib.sha256(queries.CONTROL_TEXT.encode()).hexdigest()


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).toPandas(), docs.schema)
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
    packed = pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == n
    assert packed.agg(F.max("length")).first()[0] <= 2048


def test_ids_are_those_of_a_plain_encode_for_any_characters():
    """100,000 random strings of letters, marks, symbols, gaps and special strings."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, ids = Tokenizer.from_file(path), packing._open(path, True)
    parts = [*"abcXYZHJ019", *".,;:!?%$#&*|\"'()<>-_/", " ", " ", "\n", "\t", "\u00a0", "\u0085", "\u0130", "\u0131", "\u0300", "\u0331",
             "\u030c", "\u0307", "\u0345", "\u0958", "\u095f", "\u2adc", "\u1e9e", "\u00df", "\u03a3", "\u03c2", "\u00c9", "\u00e9", "\ufb01",
             "\u0149", "\u1100", "\u1161", "\u11a8", "\uac00", "\u6f22", "\u2019", "\u201c", "\u2026", "\U0001f600", "\u200d", "\u0660",
             "\u00bd", "\u216b", "\u212a", "\u2126", "the", "Word", "it's", "I'LL", "<|endoftext|>", "<|STARTOFTEXT|>"]
    rng = random.Random(17)
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(100_000)]
    texts += ["\u0130,", "x\u0130. y", "\u0958,", "a\u0300,", "H\u0331.", "\u0130\u0307;"]
    want = [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    got = [np.frombuffer(ids.text(t), "<u4").tolist() for t in texts]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w]
    assert not bad, bad[:5]


def test_records_that_no_layout_can_take_do_not_end_the_job(spark):
    """Deep nesting, a key that reads like a path, and half a surrogate pair."""
    deep = '{"prompt": ' + "[" * 100_000 + "]" * 100_000 + "}"
    rows = [(1, deep), (2, '{"messages[].role": "a", "messages[].content": "b"}'),
            (3, '{"prompt": "\\ud800 x", "completion": "y"}'), (4, '{"prompt": "a", "completion": "b"}')]
    records = spark.createDataFrame(rows, "id long, body string")
    turns = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.turns_from_json(records, "id", "body").collect())
    assert [(t[0], t[3]) for t in turns] == [(3, "\ufffd x"), (3, "y"), (4, "a"), (4, "b")]
    why = {r.conv_id: r.reason for r in chat.rejected_from_json(records, "id", "body").collect()}
    assert why == {1: "nested too deeply", 2: "no layout", 3: "half surrogate pairs replaced"}
