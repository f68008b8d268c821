"""License scan against plain counting; quality and toxicity on held-out rows."""

import collections
import re

import numpy as np
import pytest

from tallymart.llm import licenses, quality, shared, toxicity

LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))


def phrase_places(text):
    words = words_of(text)
    found = []
    for t in licenses.PHRASES:
        phrase = t.phrase.split()
        found += [(k, t.label) for k in range(len(words)) if words[k : k + len(phrase)] == phrase]
    return words, sorted(found)


def test_phrases(spark, sf_dir, odd_docs, texts):
    more = [
        "CC-BY cc by, cc/by! MIT  LICENSE mit_license GNU general public license license by cc gnu general license public",
        "mitlicense apache licenses", "éapache license", "the apache license " * 200,
    ]
    extra = spark.createDataFrame([(2_000_000 + k, t) for k, t in enumerate(more)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id >= 300")
    docs = docs.unionByName(odd_docs.select("doc_id", "text")).unionByName(extra)
    every = {r.doc_id: r.text or "" for r in docs.collect()}
    found = licenses.license_digest(docs).collect()
    assert len(found) == len(every)
    for r in found:
        words, places = phrase_places(every[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words), len(places)), every[r.doc_id][:80]
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_every_block_above_the_threshold_is_found():
    import random

    random.seed(2)
    rare = "released under the mit license apache of any x y z".split()
    frequency = {w.encode(): random.randint(1, 9) for t in licenses.PHRASES + licenses.NOTICES for w in t.phrase.split()}
    matcher = licenses.Matcher(licenses.NOTICES, frequency)
    for _ in range(400):
        words = random.choices(rare, k=random.randint(0, 25))
        got = {(n, first): share for n, first, share in matcher.blocks(" ".join(words).encode())}
        for n, t in enumerate(licenses.NOTICES):
            own, width = set(t.phrase.split()), len(t.phrase.split())
            for k, word in enumerate(words):
                share = len(own & set(words[k : k + width])) / len(own)
                expected = word in own and share >= t.threshold
                assert got.get((n, k)) == (pytest.approx(share) if expected else None)


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def split_labels(labels):
    return labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")


def test_quality(spark, sf_dir, odd_docs, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted, held = split_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = quality.fit_quality(docs, fitted)
    found = quality.judge_quality(odd_docs, model).collect()
    assert len(found) == len(texts)
    for r in found:
        n, chars, symbols, lines, repeated = base_counts(texts[r.doc_id])
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)
    judged = quality.judge_quality(docs, model).join(held, "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in judged) >= 0.97 * len(judged)
    assert quality.judge_quality(docs.limit(0), model).count() == 0


def test_quality_without_labels_keeps_what_the_rule_keeps(spark, sf_dir, repeated):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    labels = spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    assert quality.judge_quality(docs, quality.fit_quality(docs, labels)).where("kept = base_failed").count() == 0
    assert quality.judge_quality(repeated, quality.fit_quality(docs, labels)).count() == 4


def test_a_labelled_id_gives_one_row(spark):
    docs = spark.range(300).selectExpr("id % 3 AS doc_id", "concat('text ', 1000 + id) AS text")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, None)], "doc_id long, quality int")
    found = shared.labelled_sample(docs, labels, "quality", 5).collect()
    assert sorted((r.doc_id, r.label, r.text) for r in found) == [(0, 0, "text 1000"), (1, 1, "text 1001")]


def test_toxicity(spark, sf_dir):
    words = ["fool", "jerk", "dolt"]
    name = lambda n: "".join(chr(97 + int(d)) for d in str(n))
    plain = [f"{name(k * 7919 % 997)}x {name(k * 31 % 911)}y and {name(k)}z of the" for k in range(900)]
    insults = [" ".join(words[: 1 + k // 12 % 3]).upper() if k % 4 == 0 else "" for k in range(900)]
    rows = [(k, f"{t} {insult}! of it", int(insult != "")) for k, (t, insult) in enumerate(zip(plain, insults, strict=True))]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, toxic int, quality int")
    fitted, held = split_labels(labels)
    model = toxicity.fit_toxicity(docs, fitted)
    judged = toxicity.grade_toxicity(docs, model).join(held, "doc_id").collect()
    assert sum(r.rejected == bool(r.toxic) for r in judged) >= 0.99 * len(judged)
    assert model.thresholds == tuple(sorted(model.thresholds)) and model.weights[toxicity.codes_of("jerk")[1]] > 0
    rising = [model.expected(s) for s in (-5.0, 0.0, 2.0, 9.0)]
    assert rising == sorted(rising) and 0 <= rising[0] and rising[-1] <= 2


def test_few_labelled_rows_reject_too(spark, sf_dir):
    # Eleven toxic rows of 87, too few for any one feature to be beyond chance.
    few = [spark.read.parquet(f"{sf_dir}/../sf0.001/{t}.parquet") for t in ("documents", "labels")]
    model = toxicity.fit_toxicity(*few)
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.join(few[1].select("doc_id"), "doc_id", "left_anti")
    held = toxicity.grade_toxicity(docs.where("lang = 'en'"), model).join(labels, "doc_id").collect()
    assert sum(r.rejected for r in held if r.toxic) >= 0.5 * sum(r.toxic for r in held)
    assert sum(r.rejected for r in held if not r.toxic) <= 0.03 * len(held)


def test_rare_languages_are_rejected_too(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    fitted, held = split_labels(labels)
    model = toxicity.fit_toxicity(docs, fitted)
    judged = toxicity.grade_toxicity(docs.where("lang <> 'en'"), model).join(held, "doc_id").collect()
    assert any(r.rejected for r in judged if r.toxic)
    assert sum(r.rejected for r in judged if not r.toxic) <= 0.03 * len(judged)


def test_toxicity_on_the_tables(spark, sf_dir, odd_docs, repeated):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    judged = toxicity.grade_toxicity(docs, model).join(labels, "doc_id").collect()
    assert sum(r.rejected for r in judged if not r.toxic) <= 0.01 * len(judged)
    assert sum(r.rejected for r in judged if r.toxic) >= 0.5 * sum(r.toxic for r in judged)
    assert toxicity.grade_toxicity(odd_docs, model).count() == odd_docs.count()
    assert toxicity.grade_toxicity(repeated, model).where("rejected").count() == 0
    assert toxicity.grade_toxicity(docs.limit(0), model).count() == 0


HARMLESS = [
    "Shall I compare thee to a summer's day? Thou art more lovely and more temperate: Rough winds do shake the darling "
    "buds of May, And summer's lease hath all too short a date.",
    "You are wonderful, thank you very much for your kind help yesterday!",
    "Mitochondria generate most of the chemical energy needed to power the cell's biochemical reactions.",
    "The committee meets on Thursday at noon. Please bring the signed forms, two copies each, and your badge.",
    "Wer reitet so spät durch Nacht und Wind? Es ist der Vater mit seinem Kind; er hat den Knaben wohl in dem Arm.",
    "Vielen Dank für Ihre freundliche Hilfe, wir sehen uns nächste Woche im Rathaus. Die Sitzung beginnt um neun Uhr.",
    "Sachliche Hinweise zur Steuererklärung: Belege bitte nachreichen, die Frist endet am ersten Oktober.",
    "Longtemps, je me suis couché de bonne heure. Parfois, à peine ma bougie éteinte, mes yeux se fermaient si vite.",
    "Merci beaucoup pour votre aide, nous sommes très heureux de vous accueillir demain matin.",
    "La réunion aura lieu mardi prochain; merci de confirmer votre présence auprès du secrétariat.",
    "En un lugar de la Mancha, de cuyo nombre no quiero acordarme, no ha mucho tiempo que vivía un hidalgo.",
    "Muchas gracias por su amable ayuda, nos vemos mañana en la estación central.",
    "La receta lleva arroz, azafrán, pimiento y caldo; se cocina a fuego lento durante veinte minutos.",
    "",
    None,
    " ".join(f"planted{k} word" for k in range(40)),
]


@pytest.mark.parametrize("folder", [".", "../sf0.001"])
def test_harmless_prose_is_kept(spark, sf_dir, folder):
    model = toxicity.fit_toxicity(*(spark.read.parquet(f"{sf_dir}/{folder}/{t}.parquet") for t in ("documents", "labels")))
    docs = spark.createDataFrame(list(enumerate(HARMLESS)), "doc_id long, text string")
    graded = toxicity.grade_toxicity(docs, model).collect()
    assert [r for r in graded if r.rejected] == []
    assert model.expected(0.0) + toxicity.MARGIN <= model.reject_at


def test_weights_follow_the_labels_not_the_sample(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels, rows_per_class=40)  # as many toxic as clean rows are drawn
    assert model.expected(0.0) < 0.2  # of 80 rows, half toxic
    judged = toxicity.grade_toxicity(docs, model).join(labels, "doc_id").collect()
    assert sum(r.rejected for r in judged if not r.toxic) <= 0.05 * len(judged)
    assert sum(r.rejected for r in judged if r.toxic) >= 0.5 * sum(r.toxic for r in judged)


def test_ordinal_fit_is_the_cumulative_link_models():
    random = np.random.default_rng(8)
    dense = random.random((200, 3)) * [1.0, 2.0, 0.5]
    y = np.digitize(dense @ [2.0, 0.0, -1.0] + random.logistic(size=200), [1.0, 2.0])
    share = random.random(200) + 0.5
    share /= share.sum()
    x = toxicity.Sparse([(np.arange(3), row) for row in dense])
    weights, thresholds = toxicity.fit_ordinal(x, y, share, steps=3000, prior=1.0)

    def loss(w, t):
        """Minus the mean log likelihood, with the prior, by definition: P(y <= k) is logistic in t[k] - w.x."""
        below = 1 / (1 + np.exp(-(np.array([-np.inf, *t, np.inf])[None, :] - (dense @ w)[:, None])))
        chance = below[np.arange(200), y + 1] - below[np.arange(200), y]
        return -(share * np.log(chance)).sum() + (w @ w) / 2 / 200

    assert not weights[3:].any()
    best = loss(weights[:3], thresholds)
    for step in (*np.eye(5), *-np.eye(5), *random.standard_normal((20, 5))):
        assert loss(weights[:3] + 0.01 * step[:3], np.array(thresholds) + 0.01 * step[3:]) > best
    model = toxicity.ToxicityModel(weights, thresholds)
    score = float(dense[0] @ weights[:3])
    grades = np.diff([0.0, *(1 / (1 + np.exp(score - t)) for t in thresholds), 1.0])
    assert model.expected(score) == pytest.approx(float(grades @ [0, 1, 2]))


def test_no_labels_reject_nothing(spark, repeated):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.grade_toxicity(repeated, toxicity.fit_toxicity(repeated, none)).where("rejected").count() == 0
