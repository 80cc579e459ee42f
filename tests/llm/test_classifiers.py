"""Quality and toxicity: held-out accuracy, what enters a score, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import quality, toxicity
from tests.conftest import SF_CHECK
from tests.llm.helpers import documents, labels, tuples

OPS = {"quality": (quality, quality.quality_scores, 4, 2, 0.7), "toxic": (toxicity, toxicity.toxicity_scores, 5, 0, 0.5)}


def tables(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")


@pytest.fixture(scope="module", params=sorted(OPS))
def scored(spark, request):
    docs, marks = tables(spark)
    return request.param, OPS[request.param][1](docs, marks).collect(), {r.doc_id: r[request.param] for r in marks.collect()}


def test_contract_and_held_out_accuracy(scored):
    label, rows, marks = scored
    _, _, modulus, held, threshold = OPS[label]
    assert len(rows) == 1000
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        if r.held_out and r.doc_id in marks:
            right.append(r.predicted == marks[r.doc_id])
    assert np.mean(right) >= (0.96 if label == "quality" else 0.93)


def test_scores_rest_on_the_text_and_the_training_rows_alone(spark, scored):
    label = scored[0]
    docs, marks = tables(spark)
    op = OPS[label][1]
    _, _, modulus, held, _ = OPS[label]
    # held-out labels turned round, other columns changed, rows dealt anew
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    turned = marks.withColumn(label, F.when(fold == held, 1 - F.col(label)).otherwise(F.col(label)))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0),
                              "quality": F.lit(1), "toxic": F.lit(1), "label": F.lit(0)}).repartition(7)
    again = {r.doc_id: r.score for r in op(other, turned).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in scored[1])


@pytest.mark.parametrize("label", sorted(OPS))
def test_awkward_rows(spark, label):
    docs, marks = tables(spark)
    module, op, modulus, held, threshold = OPS[label]
    rows = [(None, None), (None, "some words here"), (10 ** 9, ""), (10 ** 9, ""), (10 ** 9 + 1, None), (10 ** 9 + 2, " \n\t "),
            (10 ** 9 + 3, "é" * 300_000), (10 ** 9 + 4, "long " * 200_000), (10 ** 9 + 5, "\x00 \ud7ff \u2028 !!!")]
    extra = documents(spark, rows)
    got = op(extra.unionByName(docs, allowMissingColumns=True), marks).filter("doc_id is null or doc_id >= 1000000000").collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {label == "toxic"}
    empty = {r.score for r in got if r.doc_id in (10 ** 9, 10 ** 9 + 1)}
    assert len(empty) == 1
    keep = module.keep_good if label == "quality" else module.keep_clean
    kept = keep(extra, marks)
    assert kept.columns == extra.columns and set(tuples(kept, "doc_id", "text")) <= set(rows)
    assert op(documents(spark, []), marks).count() == 0 and keep(documents(spark, []), marks).count() == 0


@pytest.mark.parametrize("label", sorted(OPS))
def test_without_both_classes(spark, label):
    docs = documents(spark, [(k, "word " * (k + 1)) for k in range(8)])
    op = OPS[label][1]
    assert {r.score for r in op(docs, labels(spark, [])).collect()} == {0.5}
    ones = labels(spark, [(k, 1, 1) for k in range(8)] + [(None, 0, 0), (3, None, None), (4, 9, 9)])
    assert len({r.score for r in op(docs, ones).collect()}) == 1
    assert {r.predicted for r in op(docs, ones).collect()} == {1}


def test_grammar_marks():
    lexicon = toxicity.Lexicon({"fool$": 2.0, "stup": 3.0})
    def kinds(text):
        plain, aimed, negated, reported, *_ = toxicity.match(text, lexicon)
        return [round(float(np.expm1(v)), 6) for v in (plain, aimed, negated, reported)]
    assert kinds("a fool here") == [2, 0, 0, 0]
    assert kinds("you fool") == [0, 2, 0, 0]
    assert kinds("not a fool") == [0, 0, 2, 0]
    assert kinds("she said what a fool") == [0, 0, 0, 2]
    assert kinds("she said. what a fool") == [2, 0, 0, 0]  # a clause ends the report
    assert kinds("not at all in any way a fool") == [2, 0, 0, 0]  # out of the negation's scope
    assert kinds("stupidity foolish") == [3, 0, 0, 0]  # a stem matches longer words, a whole word doesn't
    assert kinds("kill the lights") == [0, 0, 0, 0] and kinds("they kill you") == [0, 1, 0, 0]
    assert kinds("") == kinds(None) == [0, 0, 0, 0]


@pytest.mark.parametrize("text", [
    "I will kill you", "kill them", "we shall destroy her", "ich werde dich töten", "wir töten dich", "wir werden töten euch alle",
    "je vais te tuer", "je vais tuer vous", "on va détruire toi", "te voy a matar", "voy a matar a usted", "vamos a destruir a ellos"])
def test_threats_before_or_after_their_target(text):
    aimed = lambda t: [round(float(np.expm1(v)), 6) for v in toxicity.match(t, toxicity.Lexicon({}))[:4]]
    assert aimed(text) == [0, 1, 0, 0]
    assert aimed("never kill them") == [0, 0, 1, 0]
    assert aimed("kill the lights in the house for you") == [0, 0, 0, 0]  # out of the target's scope
    assert aimed("kill and destroy you") == [0, 2, 0, 0] and aimed("kill it. you") == [0, 0, 0, 0]


def test_reports_and_negations_cross_colons_and_lines():
    lexicon = toxicity.Lexicon({"fool$": 2.0})
    kinds = lambda t: [round(float(np.expm1(v)), 6) for v in toxicity.match(t, lexicon)[:4]]
    reported = ["she said: you fool", "he wrote:\nyou fool", "she said that this man\nis a fool", '"fool", he said',
                '"you fool!" he said', "\u201cyou fool!\u201d, the man said", "er sagte: fool", "il a dit: fool", '"fool", dijo ella']
    assert [kinds(t) for t in reported] == [[0, 0, 0, 2]] * len(reported)
    assert kinds("he is not\na fool") == [0, 0, 2, 0] and kinds("you\nfool") == [0, 2, 0, 0]
    assert kinds("i will kill\nyou") == [0, 1, 0, 0]
    for t in ("she said so.\n\na fool", "she said so\n \r\na fool", "a fool! she said so", "a fool... she said so", "a fool; she said so"):
        assert kinds(t) == [2, 0, 0, 0]  # sentence ends and blank lines end a clause


def test_composition_is_the_step_by_step_run():
    one, two = toxicity.scope(toxicity.NEGATION, "negated"), toxicity.rest_of_clause(toxicity.REPORT, "reported")
    both = one.then(two)
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = a = b = 0
        for x in rng.integers(0, 6, 12).tolist():
            s, flags = both.step(s, frozenset(), x)
            a, f = one.step(a, frozenset(), x)
            b, f = two.step(b, f, x)
            assert flags == f and s == a * two.states + b


def test_one_copied_text_teaches_no_words(spark):
    rows, marks = [], []
    for k in range(400):
        toxic = k % 4 == 0
        text = " ".join(f"w{(k * 7 + j * j) % 90}x" for j in range(30)).replace("0", "o").translate(str.maketrans("123456789", "abcdefghi"))
        rows.append((k, text + (" awful" if toxic else "")))
        marks.append((k, 1, int(toxic)))
    rows += [(1000 + k, "odd petal grove under seven lamps awful") for k in range(300)]
    marks += [(1000 + k, 1, 1) for k in range(300)]
    model = toxicity.train(documents(spark, rows), labels(spark, marks))
    assert "awful$" in model.lexicon.weights and not {"petal$", "grove$", "lamps$"} & set(model.lexicon.weights)


def test_discriminant_separates_by_spread_alone():
    rng = np.random.default_rng(2)
    d = len(quality.NAMES)
    x = np.vstack([rng.normal(0, 0.2, (500, d)), rng.normal(0, 2.0, (500, d))])
    y = np.repeat([1, 0], 500)
    score = quality.Discriminant(x, y).score(x)
    assert ((score >= 0.5) == (y == 1)).mean() > 0.99
    assert quality.Discriminant(x[:1], y[:1]).score(x[:2]).tolist() == [0.75, 0.75]


def test_discriminant_equals_explicit_inverses(spark):
    """Scores of the operator against the textbook formula, with inverses and determinants in full, on the
    same training rows."""
    docs, marks = tables(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    label = {}
    for r in marks.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.doc_id in texts and r.quality in (0, 1):
            label[r.doc_id] = max(r.quality, label.get(r.doc_id, 0))
    ids = sorted(label)
    x = np.array([quality.statistics(texts[i]) for i in ids])
    y = np.array([label[i] for i in ids])
    share, d = (y.sum() + 0.5) / (len(y) + 1.0), x.shape[1]
    mean = {c: x[y == c].mean(axis=0) for c in (0, 1)}
    cov = {c: np.cov(x[y == c].T, bias=True) for c in (0, 1)}
    pooled = sum((y == c).sum() * cov[c] for c in (0, 1)) / len(y)
    inverse, determinant = {}, {}
    for c in (0, 1):
        own = 0.1 + 0.9 * d / (d + (y == c).sum())
        s = (1 - own) * cov[c] + own * pooled
        s = 0.95 * s + 0.05 * np.diag(np.diag(s)) + np.diag(1e-6 + 1e-3 * np.diag(pooled))
        inverse[c], determinant[c] = np.linalg.inv(s), np.linalg.det(s)

    def odds(v):
        density = {c: -0.5 * ((v - mean[c]) @ inverse[c] @ (v - mean[c]) + np.log(determinant[c])) for c in (0, 1)}
        return np.arcsinh(density[1] - density[0] + np.log(share / (1 - share)))
    train = np.array([odds(v) for v in x])
    # the two coefficients of the calibration, by plain Newton steps
    b = np.zeros(2)
    a = np.column_stack([np.ones(len(y)), train])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-6, 0.1]), a.T @ (y - p) - np.array([1e-6, 0.1]) * b)
        b += np.clip(step, -5, 5)
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, marks).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        v = np.array(quality.statistics(t))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(b[0] + b[1] * odds(v), -700, 700))), abs=1e-6)


@pytest.mark.parametrize("text", ["he killed them", "er tötet dich", "je te tue", "te mato", "they were beating her", "ils vont vous frapper",
                                  "wir vernichten euch", "los mataremos o te mataré", "ihr werdet von uns geschlagen sie"])
def test_inflected_threats(text):
    plain, aimed, negated, reported = (float(np.expm1(v)) for v in toxicity.match(text, toxicity.Lexicon({}))[:4])
    assert aimed >= 1 and plain == negated == reported == 0


def test_negations_behind_a_threat_turn_it():
    kinds = lambda t: [round(float(np.expm1(v)), 6) for v in toxicity.match(t, toxicity.Lexicon({"fool$": 2.0}))[:4]]
    assert kinds("ich töte dich nicht") == [0, 0, 1, 0] and kinds("je ne tue pas vous") == [0, 0, 1, 0]
    assert kinds("ich töte dich. nicht") == [0, 1, 0, 0]  # another clause
    assert kinds("you fool do not know") == [0, 2, 0, 0]  # an insult isn't turned by what follows


def test_the_weight_of_threats_is_learned(spark):
    """Documents that aim a threat: mostly toxic in one corpus, as often clean in another."""
    def corpus(toxic_share):
        rows, marks = [], []
        for k in range(600):
            threat, toxic = k % 4 == 0, (k // 4) % 100 < toxic_share if k % 4 == 0 else k % 12 == 1
            words = " ".join("abcdefghij"[int(c)] * 3 for c in str(k * 7919))
            rows.append((k, f"{words} we will kill you {words}" if threat else f"{words} a calm day {words}"))
            marks.append((k, 1, int(toxic)))
        return documents(spark, rows), labels(spark, marks)
    heavy = toxicity.train(*corpus(95)).lexicon.threat
    light = toxicity.train(*corpus(25)).lexicon.threat
    assert heavy > 2 > light >= 0


def test_match_equals_a_step_by_step_reading():
    """The composed tables against plain rules applied word by word."""
    lexicon = toxicity.Lexicon({"fool$": 2.0, "stup": 3.0})
    vocabulary = ["fool", "stupid", "kill", "killed", "you", "them", "not", "never", "said", "a", "day", "calm", "tree"]
    rng = np.random.default_rng(4)

    def plain(words):
        sums = dict.fromkeys(toxicity.KINDS, 0.0)
        for k, w in enumerate(words):
            insult, threat = lexicon.weight(w), w in toxicity.THREATS
            if not insult and not threat:
                continue
            def within(of, places):
                return any(0 <= p < len(words) and words[p] in of for p in places)
            before, after = range(k - toxicity.SCOPE, k), range(k + 1, k + 1 + toxicity.SCOPE)
            aimed = within(toxicity.TARGETS, before) or within(toxicity.TARGETS, after)
            negated = within(toxicity.NEGATIONS, before) or (not insult and within(toxicity.NEGATIONS, after))
            reported = any(x in toxicity.REPORTS for x in words)
            if not insult and not aimed:
                continue
            kind = "negated" if negated else "reported" if reported else "aimed" if aimed else "plain"
            sums[kind] += insult or lexicon.threat
        return list(sums.values())
    for _ in range(400):
        words = rng.choice(vocabulary, rng.integers(1, 14)).tolist()
        got = [float(np.expm1(v)) for v in toxicity.match(" ".join(words), lexicon)[:4]]
        assert got == pytest.approx(plain(words)), words
