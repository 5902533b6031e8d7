"""Quality, toxicity and language: held-out accuracy, edge cases, determinism."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import language, quality, toxicity
from driftline.llm.common import held_out, table
from tests.conftest import SF_MID

ODD = "doc_id long, text string, lang string, score string, predicted int, label int, text_hash long"
ODD_ROWS = [(None, "some plain words here", "en", "x", 1, 0, 1), (7, None, None, None, None, None, None),
            (8, "", "en", "x", 1, 0, 1), (9, "123 456 !!", "de", "x", 1, 0, 1),
            (10, "same text twice", "en", "x", 1, 0, 1), (10, "same text twice", "en", "x", 1, 0, 1),
            (11, "word " * 60_000, "en", "x", 1, 0, 1), (12, "über straße día\u0000\U0001f600", "de", "x", 1, 0, 1)]


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD)


def labels(spark):
    return table(spark, SF_MID, "labels")


def test_held_out_is_the_crc_of_the_decimal_text(spark):
    got = spark.range(-5, 200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def judged(spark, scored, label):
    rows = scored.join(labels(spark), "doc_id").where(held_out(F.col("doc_id"))).select("predicted", label).collect()
    return np.array([(r[0], r[1]) for r in rows])


def test_quality_held_out_and_edge_cases(spark):
    docs = table(spark, SF_MID, "documents")
    got = judged(spark, quality.score_quality(docs, labels(spark)), "quality")
    assert (got[:, 0] == got[:, 1]).mean() >= 0.97
    model = quality.train(docs, labels(spark))
    rows = odd(spark).withColumn("s", quality.score_column(model, F.col("text"))).collect()
    assert all(0 <= r.s <= 1 for r in rows)
    assert rows[1].s == rows[2].s == 0 and rows[4].s == rows[5].s
    kept = quality.keep_good(odd(spark), labels(spark))
    assert kept.columns == odd(spark).columns
    assert quality.keep_good(docs.limit(0), labels(spark)).count() == 0
    assert quality.keep_good(docs, labels(spark).limit(0)).count() == docs.count()  # nothing learnt: score 0.5


def test_quality_factor_gives_the_gaussian_log_density():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (300, 3))])
    y = np.repeat([0, 1], 300)
    model = quality.fit(x, y, pooled=0.0, spherical=0.0, temperature=1.0)
    z = (x - model.centre) / model.scale
    want = []
    for k in (0, 1):
        mean, cov = z[y == k].mean(axis=0), np.cov(z[y == k].T, bias=True)
        d = z - mean
        want.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.log(np.linalg.det(cov)))
    assert np.allclose(model.log_odds(x), want[1] - want[0])


def test_toxicity_held_out_and_edge_cases(spark):
    docs = table(spark, SF_MID, "documents")
    model = toxicity.train(docs, labels(spark))
    scored = docs.select("doc_id", (toxicity.score_column(model, F.col("text")) >= 0.7).cast("int").alias("predicted"))
    got = judged(spark, scored, "toxic")
    clean, toxic = got[got[:, 1] == 0, 0], got[got[:, 1] == 1, 0]
    assert clean.mean() <= 0.03 and toxic.mean() >= 0.6  # some forty toxic learning documents only
    rows = odd(spark).withColumn("s", toxicity.score_column(model, F.col("text"))).collect()
    assert rows[1].s == rows[2].s == 0 and rows[4].s == rows[5].s and all(0 <= r.s <= 1 for r in rows)
    assert toxicity.score_toxicity(docs.limit(0), labels(spark)).count() == 0


def test_toxic_words_shorten_only_against_the_toxic_dictionary():
    rng = np.random.default_rng(3)
    plain = [" ".join(f"w{i}" for i in rng.integers(0, 400, 80)) for _ in range(160)]
    texts = [t + " vile nasty awful wretch" if k % 2 else t for k, t in enumerate(plain)]
    model = toxicity.fit(texts, np.arange(160) % 2)
    sizers = model.dictionaries.sizers()
    new = [" ".join(f"w{i}" for i in rng.integers(0, 400, 80)) for _ in range(20)]
    low = model.scores(new, sizers)
    high = model.scores([t + " nasty vile wretch" for t in new], sizers)
    assert (high > 0.7).all() and (low < 0.5).all()


def test_toxicity_letters_are_hashes_of_the_words_beginnings():
    one = np.frombuffer(toxicity.letters(["über", "überall", "über"]), np.uint32)
    assert len(one) == 18 and (one[:4] == one[5:9]).all() and (one[:5] == one[13:]).all()
    assert len(set(one[:13].tolist())) == 9  # four shared letters; the blank tells the whole word
    alone = b"".join(toxicity.letters([w]) for w in ("über", "überall", "über"))
    assert one.tobytes() == alone
    assert all(u == toxicity.letters([w]) for w, u in toxicity.units(["b", "über", "b", "x" * 300]).items())
    words = toxicity.words_of("a bc " * 2000 + "x" * 600)
    assert len(words) == 4003
    assert b"".join(toxicity.windows(words)) == b"".join(map(toxicity.letters, ([w] for w in words)))


def test_toxicity_counts_repeats_and_the_order_of_words():
    rng = np.random.default_rng(5)
    plain = [" ".join(f"w{i}" for i in rng.integers(0, 300, 60)) for _ in range(120)]
    texts = [t + " vile nasty awful wretch" if k % 2 else t for k, t in enumerate(plain)]
    sizers = toxicity.fit(texts, np.arange(120) % 2).dictionaries.sizers()
    once = toxicity.words_of(plain[0] + " nasty " + plain[2])
    twice = toxicity.words_of(plain[0] + " nasty " + plain[2] + " nasty")
    total = [toxicity.excesses(toxicity.windows(w), *sizers).sum() for w in (once, twice)]
    assert total[1] > total[0] > 0
    phrase = toxicity.letters(["vile", "nasty", "awful", "wretch"])
    parts = toxicity.Dictionaries(b"\0" * 4096, b"\0" * 4000 + phrase).sizers()
    in_order = toxicity.excesses([phrase], *parts)[0]
    mixed = toxicity.excesses([toxicity.letters(["awful", "vile", "wretch", "nasty"])], *parts)[0]
    assert in_order > mixed > 0


@pytest.fixture(scope="module")
def net(spark):
    return language.train(table(spark, SF_MID, "documents"))


def test_language_held_out_and_edge_cases(spark, net):
    docs = table(spark, SF_MID, "documents")
    rows = docs.where(held_out(F.col("doc_id"))).select("lang", language.language_column(net, F.col("text")).alias("f")).collect()
    assert np.mean([r.lang == r.f.lang_pred for r in rows]) >= 0.97
    got = odd(spark).select(language.language_column(net, F.col("text")).alias("f")).collect()
    assert [got[k].f.lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[4].f == got[5].f
    assert all(0 <= r.f.score <= 1 for r in got)
    assert language.identify(odd(spark).limit(0)).count() == 0
    kept = language.keep_known(odd(spark))
    assert kept.columns == odd(spark).columns


def test_language_positions_cover_the_text_and_agree_with_the_pool(net):
    for n in (1, 63, 64, 65, 130):
        text = ("the of and that with from " * 10)[:n]
        assert len(language.position_labels(net, text)) == n
    assert language.position_labels(net, "") == []
    text = "der die und nicht mit sich " * 9
    best = language.position_labels(net, text)
    assert max(set(best), key=best.count) == language.predict(net, [text])[0][0]


def test_backpropagation_matches_finite_differences():
    rng = np.random.default_rng(0)
    layer = {k: v.astype(np.float64) for k, v in language._layer(rng, 3).items()}
    x = rng.integers(0, 5, (6, 4))
    goal = rng.normal(size=(6, 4, 3))

    def value():
        return float((language.forward(layer, x).astype(np.float64) * goal).sum())

    tape: list = []
    language.forward(layer, x, tape)
    grad = language.backward(layer, x, tape, goal)
    for name, at in (("u", (1, 4)), ("u", (2, 7)), ("b", (1,)), ("w", (2, 5)), ("w", (3, 0))):
        keep = layer[name][at]
        ends = []
        for step in (1e-2, -1e-2):
            layer[name][at] = keep + step
            ends.append(value())
        layer[name][at] = keep
        assert abs((ends[0] - ends[1]) / 2e-2 - grad[name][at]) < 2e-2 * max(1, abs(grad[name][at]))


def test_language_sample_is_bounded_and_fair_with_repeated_rows(spark):
    from driftline.llm import language
    rows = [(k, f"text {k % 40} of {'abcd'[k % 4]} " * 3, "abcd"[k % 4]) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    many = docs.crossJoin(spark.range(500)).drop("id")  # each row 500 times
    got, plain = language.learning_rows(many, 20), language.learning_rows(docs, 20)
    assert sorted(got["lang"].unique()) == list("abcd") and got["lang"].value_counts().max() <= 5
    assert got.equals(plain)
