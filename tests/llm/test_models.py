import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import language, pii, quality
from cairn.llm.queries import op6_language, op7_personal_data

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


# quality ---------------------------------------------------------------------------------------------------------

def test_ordinal_gradient_fits_ordered_grades():
    rng = np.random.default_rng(1)
    rows, grade = [], []
    for _ in range(900):
        y = int(rng.integers(0, 3))
        words = rng.choice(np.arange(10, 400), 30, replace=False).tolist()
        words += [1] * (y == 0) + [2] * (y == 1)
        rows.append(np.array(sorted(set(words))))
        grade.append(y)
    model = quality.fit(rows, np.array(grade), [1 / 3] * 3)
    assert np.all(np.diff(model.thresholds) >= 0) and model.weights[1] < model.weights[2] < 0
    tails = model.tails(np.array([model.weights[r].sum() for r in rows]))
    assert np.all(tails[:, 0] >= tails[:, 1])  # P(grade >= 1) >= P(grade >= 2)
    assert (np.round(tails.sum(axis=1)) == grade).mean() > 0.97


def test_labels_that_were_not_learned_from_are_predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = quality.graded_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    learned = labels.where("doc_id % 3 != 0")
    held = quality.grade_documents(docs, learned).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    clean = [r.kept for r in held if r.grade == 2]
    others = [r.kept for r in held if r.grade != 2]
    assert len(held) > 50 and np.mean(clean) > 0.97 and np.mean(others) < 0.25


def test_ratings_that_teach_nothing(documents, awkward, spark):
    none = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, grade int")
    assert all(r.kept and r.tail_probability == 1.0 for r in quality.grade_documents(documents(["a", None]), none).collect())
    rated = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(0, 1)], "doc_id long, grade int")
    docs = documents([("bad " if k % 2 == 0 else "good ") * 5 + f"x{k}" for k in range(40)])
    model = quality.learn(docs, rated)
    got = awkward.select(quality.scores(F.col("text"), model).alias("s"), "text").collect()
    assert len(got) == awkward.count()
    assert all(r.s.expected_grade == 0 and r.s.tails == [0.0] for r in got if not (r.text or "").strip())


def test_tails_against_plain_sums(documents, spark):
    """Expected grade and tail probability from the model's weights and thresholds, one document at a time."""
    rated = spark.createDataFrame([(k, k % 3) for k in range(90)], "doc_id long, grade int")
    docs = documents([("awful bad " if k % 3 == 0 else "plain dull " if k % 3 == 1 else "lovely fine ") * 4 + f"x{k} y{k % 5}" for k in range(120)]
                     + [None, "", "12 !"])
    model = quality.learn(docs, rated)
    got = {r.doc_id: r for r in quality.grade_documents(docs.withColumn("kept", F.lit("old")), rated).collect()}
    for r in docs.collect():
        features = quality.hashed_tokens(r.text, {}) if r.text else []
        s = sum(float(model.weights[f]) for f in features)
        tails = [1 / (1 + math.exp(t - s)) for t in model.thresholds] if len(features) else [0.0, 0.0]
        assert got[r.doc_id].expected_grade == pytest.approx(sum(tails), abs=1e-9)
        assert got[r.doc_id].tail_probability == pytest.approx(tails[1], abs=1e-9)
        assert got[r.doc_id].kept == (got[r.doc_id].tail_probability >= 0.5)
    assert [got[k].kept for k in range(90, 120)] == [k % 3 == 2 for k in range(90, 120)]


def test_ordinal_thresholds_and_gradient_against_the_likelihood():
    """At the fitted model the likelihood cannot be raised by moving a threshold."""
    rng = np.random.default_rng(5)
    grade = rng.integers(0, 3, 600)
    rows = [np.array(sorted({int(x) for x in rng.integers(10, 60, 8)} | ({1} if g == 2 else {2} if g == 0 else set()))) for g in grade]
    model = quality.fit(rows, grade, [1 / 3] * 3, l1=0.0, steps=3000)
    s = np.array([model.weights[r].sum() for r in rows])

    def loss(theta):
        cut = np.concatenate(([-np.inf], theta, [np.inf]))
        sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -700, 700)))
        weight = (1 / 3) / np.bincount(grade)[grade]
        return -(weight * np.log(np.maximum(sigmoid(cut[grade + 1] - s) - sigmoid(cut[grade] - s), 1e-12))).sum()

    best = loss(model.thresholds)
    for k in range(2):
        for step in (-0.5, 0.5):
            moved = model.thresholds.copy()
            moved[k] += step
            assert loss(np.sort(moved)) >= best - 1e-6


def test_the_quality_sample_counts_copies_once(documents, spark):
    rated = spark.createDataFrame([(k, 0 if k < 300 else 1) for k in range(600)], "doc_id long, grade int")
    docs = documents(["same bad text"] * 290 + [f"bad thing {k}" for k in range(10)] + [f"good thing {k}" for k in range(300)])
    one, two = (quality.learn(docs.repartition(n), rated, per_grade=300) for n in (1, 7))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()


def test_no_documents_to_grade(nothing, spark):
    rated = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, grade int")
    assert quality.grade_documents(nothing, rated).count() == 0


# language --------------------------------------------------------------------------------------------------------

def test_training_against_plain_ftrl():
    """Coordinate by coordinate: the proximal leader with elastic net, in the same order of rows."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(40):
        at = np.sort(rng.choice(30, 6, replace=False))
        rows.append((at, rng.random(6), int(at[0] % 3)))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    z, n, w = ({} for _ in range(3))
    order = np.random.default_rng(1)
    for _ in range(4):
        for k in order.permutation(len(rows)):
            at, value, label = rows[k]
            logit = [sum(v * w.get((f, c), 0.0) for f, v in zip(at, value)) for c in range(3)]
            e = [math.exp(x - max(logit)) for x in logit]
            for c in range(3):
                error = e[c] / sum(e) - (c == label)
                for f, v in zip(at, value):
                    g, old = v * error, n.get((f, c), 0.0)
                    sigma = (math.sqrt(old + g * g) - math.sqrt(old)) / alpha
                    z[f, c] = z.get((f, c), 0.0) + g - sigma * w.get((f, c), 0.0)
                    n[f, c] = old + g * g
                    x = z[f, c]
                    w[f, c] = 0.0 if abs(x) <= l1 else -(x - math.copysign(l1, x)) / ((beta + math.sqrt(n[f, c])) / alpha + l2)
    got = language.train(rows, 3)
    for (f, c), x in w.items():
        assert got[f, c] == pytest.approx(x, abs=1e-9)
    assert np.count_nonzero(got[30:]) == 0


def plain_ngrams(text):
    kept = re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in f" {text} "))
    return [sum(len(kept) - n + 1 for n in (1, 2, 3))]


@pytest.mark.parametrize("text", ["Abc def", "  É  ß 12 x ", "日本 語 text", "a" * 3000])
def test_ngram_counts(text, monkeypatch):
    letters = language.letters_below()
    counts = language.ngram_counts(text, letters)
    assert counts.sum() == plain_ngrams(text)[0]
    assert (language.ngram_counts(text.upper(), letters) == counts).all() or "ß" in text
    assert language.ngram_counts(" 12 !", letters) is None


def test_regularised_leader_is_sparse_and_separates():
    rng, rows = np.random.default_rng(2), []
    for _ in range(600):
        y = int(rng.integers(0, 3))
        at = np.unique(np.concatenate(([100 + y, 200 + y], rng.integers(1000, 9000, 20))))
        rows.append((at, np.full(len(at), len(at) ** -0.5), y))
    w = language.train(rows[:400], 3, l1=0.3)
    assert np.mean([int((v @ w[at]).argmax()) == y for at, v, y in rows[400:]]) > 0.95
    assert (w != 0).sum() < 0.5 * 8000 * 3


def test_temperature_matches_overconfidence():
    rng = np.random.default_rng(3)
    true = rng.standard_normal((4000, 3)) * 2
    p = np.exp(true) / np.exp(true).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=q) for q in p])
    assert language.temperature(true * 4, labels) == pytest.approx(4, rel=0.15)


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op6_language(spark, SF).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and 150 < len(held) < 350
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_the_held_out_labels_are_not_read(spark, documents):
    texts = [("uno dos tres cuatro " if k % 2 else "one two three four ") * 3 for k in range(120)]
    df = documents(texts, lang=["es" if k % 2 else "en" for k in range(120)])
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    spoiled = df.withColumn("lang", F.when(fold == 2, F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(language.identify(df).collect()) == sorted(language.identify(spoiled).collect())
    unknown = language.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_awkward_languages(awkward, nothing):
    got = language.identify(awkward).collect()
    assert len(got) == awkward.count() and language.identify(nothing).count() == 0


def test_copies_are_one_text_of_their_language(documents, monkeypatch):
    used = []
    fit = language.train
    monkeypatch.setattr(language, "train", lambda rows, classes: used.extend(r[2] for r in rows) or fit(rows, classes))
    texts = ["one two three four"] * 3000 + [f"cinco seis {chr(97 + k % 26)}{chr(97 + k // 26)} siete" for k in range(60)]
    model = language.learn(documents(texts, lang=["en"] * 3000 + ["es"] * 60), per_class=40, max_rows=100)
    assert model.names == ["en", "es"] and used.count(0) == 1 and used.count(1) == 32


def test_too_many_languages_are_refused(documents):
    df = documents(["one two", "uno dos", "un deux"], lang=["en", "es", "fr"])
    with pytest.raises(ValueError, match="max_languages"):
        language.learn(df, max_languages=2)
    assert language.learn(df, max_languages=3).names == ["en", "es", "fr"]


# personal data ---------------------------------------------------------------------------------------------------

def plain_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        check = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and check % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_patterns_against_plain_regular_expressions():
    rng = random.Random(6)
    bits = ["a", "B.c", "@", "@x.y", "1", "12", ".", "..", "-", " ", "+", "4111 1111 1111 1111", "255", "256", "()", "é", "\n",
            "a@b.c@d.e", "1.2.3.4.5.6.7.8", "007.0.0.1", "%", "+1 (499) 555-6503", "4111-1111-1111-1112"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.pattern_spans(text)] == plain_spans(text), text


def test_patterns_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "@" * 200_000, "+1" * 100_000, "1." * 100_000, "a@" * 100_000, "1 " * 100_000):
        pii.all_spans(text, None, 0.9)
        pii.tokens_of(text)


def exact(field, g):
    """Marginals by summing over all labellings."""
    import itertools

    total = np.zeros((len(g.place), pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=len(g.place)):
        s = 0.0
        for i, k in enumerate(y):
            s += field.unary[g.features[i]].sum(axis=0)[k] if g.observed[i] < 0 else (0 if k == g.observed[i] else -50)
        s += sum(field.chain[y[i], y[j]] for i, j in g.chain) + sum(field.skip[y[i], y[j]] for i, j in g.skip)
        for i, k in enumerate(y):
            total[i, k] += np.exp(s)
    return total / total.sum(axis=1, keepdims=True)


def test_messages_against_enumeration():
    rng = np.random.default_rng(4)
    skip = rng.normal(size=(5, 5))
    field = pii.Field(rng.normal(size=(20, 5)), rng.normal(size=(5, 5)), skip + skip.T)
    places, features = [(k, k + 1) for k in range(5)], [[int(k)] for k in rng.integers(0, 20, 5)]
    tree = pii.Graph(places, features, [-1, 2, -1, -1, -1], [(0, 1), (1, 2)], [(0, 3), (2, 4)])
    assert np.allclose(field.marginals(tree, rounds=60), exact(field, tree), atol=1e-6)  # no loop: exact
    loop = pii.Graph(places, features, [-1] * 5, [(0, 1), (1, 2), (2, 3)], [(0, 3), (1, 4)])
    assert np.abs(pii.Field(field.unary, field.chain * 0.3, field.skip * 0.3).marginals(loop, rounds=60)
                  - exact(pii.Field(field.unary, field.chain * 0.3, field.skip * 0.3), loop)).max() < 0.05


def test_a_repeated_number_is_found_by_its_skip_edge():
    unary, same = np.zeros((1 << pii.BITS, 5)), np.eye(5) * 5
    field = pii.Field(unary, np.zeros((5, 5)), same)
    text = "call +1 (499) 555-6503 now or later 555-6503 again, not 777-1212"
    base, spans = pii.all_spans(text, field, 0.9)
    assert [text[s:e] for _, s, e in base] == ["+1 (499) 555-6503"]
    assert [text[s:e] for _, s, e in spans] == ["+1 (499) 555-6503", "555-6503"]
    assert pii.redacted(text, spans) == "call <PHONE> now or later <PHONE> again, not 777-1212"


def test_a_number_repeated_fifty_times_is_found_at_every_place():
    field = pii.Field(np.zeros((1 << pii.BITS, 5)), np.zeros((5, 5)), np.eye(5) * 12)
    for before, after in ((0, 50), (50, 0), (20, 30)):
        text = "555-6503 again, " * before + "call +1 (499) 555-6503 now, " + "or 555-6503 later " * after + "not 777-1212"
        _, spans = pii.all_spans(text, field, 0.9)
        assert [text[s:e] for _, s, e in spans] == ["555-6503"] * before + ["+1 (499) 555-6503"] + ["555-6503"] * after


def test_settled_messages_equal_a_thousand_full_rounds():
    rng = np.random.default_rng(5)
    skip = rng.normal(size=(5, 5))
    field = pii.Field(rng.normal(size=(20, 5)), rng.normal(size=(5, 5)) * 0.5, (skip + skip.T) * 0.3)
    n = 300
    pairs = sorted({tuple(sorted(map(int, rng.choice(n, 2, replace=False)))) for _ in range(200)})
    g = pii.Graph([(k, k + 1) for k in range(n)], [[int(k)] for k in rng.integers(0, 20, n)],
                  [2 if k % 50 == 7 else -1 for k in range(n)], [(k, k + 1) for k in range(n - 1)], pairs)
    assert np.allclose(field.marginals(g), field.marginals(g, rounds=1000, tolerance=0.0), atol=1e-3)


def test_messages_that_never_settle_end():
    field = pii.Field(np.zeros((20, 5)), np.roll(np.eye(5), 1, axis=1) * 9, -np.eye(5) * 9)
    n = 400
    g = pii.Graph([(k, k + 1) for k in range(n)], [[k % 20] for k in range(n)], [1] + [-1] * (n - 1),
                  [(k, k + 1) for k in range(n - 1)], [(k, k + 7) for k in range(n - 7)])
    p = field.marginals(g)
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1)


def sampled(df, monkeypatch, **options):
    """Labels of the documents that the field is fitted on."""
    monkeypatch.setattr(pii, "fit", lambda graphs: [y.tolist() for _, y, _, _ in graphs])
    return pii.learn(df, **options)


def test_kinds_of_late_rows_and_long_documents_are_learned(documents, monkeypatch):
    texts = [f"number {k} of many" for k in range(3000)] + ["the same 12 words"] * 3000
    texts += ["9 " * 40 + f"mail a{k}@b.example now" for k in range(30)] + ["7 " * 900 + "ip 10.1.2.3 " + "8 " * 900]
    df = documents(texts).coalesce(1)
    got = sampled(df, monkeypatch, fit_documents=100, fit_tokens=50)
    assert len(got) == 100 and max(map(len, got)) <= 50
    assert sum(1 in y for y in got) >= 10 and sum(2 in y for y in got) == 1
    again = sampled(df.orderBy(F.col("doc_id").desc()).repartition(7), monkeypatch, fit_documents=100, fit_tokens=50)
    assert sorted(got) == sorted(again)  # the order of the rows has no say


def test_copies_take_one_place_of_the_sample(documents, monkeypatch):
    texts = ["call +1 (499) 555-6503"] * 500 + [f"room {k}" for k in range(20)]
    got = sampled(documents(texts), monkeypatch, fit_documents=30)
    assert len(got) == 21 and sum(4 in y for y in got) == 1


def test_all_documents_keep_their_pattern_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op7_personal_data(spark, SF).collect():
        want = [f"{k}:{s}:{e}" for k, s, e in plain_spans(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        got = r.spans.split(",") if r.spans else []
        assert set(want) <= set(got)
        assert got == sorted(got, key=lambda x: (pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))


def test_awkward_texts(awkward, nothing):
    assert pii.find(awkward).count() == awkward.count()
    assert all(r.base == [] and r.spans == [] for r in pii.find(awkward.where("text is null")).collect())
    out = pii.redact(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert pii.find(nothing).count() == 0 and pii.redact(nothing).count() == 0
