"""Quality rules and toxicity: models against plain computations, held-out accuracy, odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import quality, toxicity
from carelake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen, copies = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(covered)


def test_plain_statistics(texts):
    rng = random.Random(2)
    odd = ["", " ", "a", "a b", "a b c a b c", "a a a", "x\n\nx\n x\nx", "é é \x0bé\x1cé #<>", "\n".join(["l 1", " ", "l 1", "\t", "l 1"])]
    odd += ["".join(rng.choices("ab \n#", k=200)) for _ in range(200)]
    for text in [*odd, *(t for _, t in texts[:80])]:
        assert quality.plain_statistics(text) == plain_statistics(text), text


def test_statistics_by_pieces(monkeypatch):
    text = " ".join(random.Random(5).choices("ab cd ef".split(), k=400))
    whole = quality.plain_statistics(text)
    monkeypatch.setattr("carelake.llm.simhash._PIECE", 11)
    assert quality.plain_statistics(text) == whole


def plain_points(text):
    low = [c.lower() if len(c.lower()) == 1 else c for c in text]
    return [1] * 4 + [0xFFFD if ord(c) < 2 else ord(c) for c in low]


def plain_kneser_ney(corpus):
    """Probability of a code point after four others, from nested dictionaries."""
    symbols = [plain_points(text) for text in corpus]
    counts = {5: Counter(tuple(s[i - 4 : i + 1]) for s in dict.fromkeys(map(tuple, symbols)) for i in range(4, len(s)))}
    met = {5: counts[5]}
    for n in (4, 3, 2, 1):
        left, met[n] = defaultdict(set), Counter()
        for gram in counts[n + 1]:
            left[gram[1:]].add(gram[0])
            met[n][gram[1:]] += met[n + 1][gram]
        counts[n] = Counter({g: len(v) for g, v in left.items()})

    def discounts(n):
        t = Counter(min(c, 5) for c in counts[n].values())
        base = t[1] / (t[1] + 2 * t[2]) if t[1] + t[2] else 0.0
        return [0.0] + [min(max(k - (k + 1) * base * t[k + 1] / t[k] if t[k] else base * k, 0.0), k) for k in (1, 2, 3)]

    cuts = {n: discounts(n) for n in counts}
    around = defaultdict(list)
    for n in counts:
        for gram in counts[n]:
            around[gram[:-1]].append(gram)

    def own(gram):
        n = len(gram)
        return counts[n][gram] - cuts[n][min(counts[n][gram], 3)] if n == 1 or met[n][gram] > 1 else 0.0

    def probability(gram):
        n = len(gram)
        total = sum(counts[n][g] for g in around[gram[:-1]])
        rest = 1 - sum(own(g) for g in around[gram[:-1]]) / total
        return own(gram) / total + rest * (probability(gram[1:]) if n > 1 else 1 / (len(counts[1]) + 1))

    return symbols, probability


def plain_sums(corpus):
    symbols, probability = plain_kneser_ney(corpus)
    return [sum(math.log(probability(tuple(s[i - 4 : i + 1]))) for i in range(4, len(s))) for s in symbols]


def sums_of(docs):
    marked = quality.scored(docs, ["doc_id"], "text", "lang", True)
    found = {r["_of"]: r["_sum"] for r in quality.perplexities(docs, quality.model_of(docs, marked)).collect()}
    return {r["doc_id"]: found.get(r["_digest"]) for r in marked.collect()}


CORPUS = ["the cat sat on the mat", "a cat and a hat, the end.", "\u00c9tude 12 #", "thththth", "\u0130x \x00\x01 \U0001f600 the cat", "\u6f22\u5b57 the cat", ""]


def test_model_equals_plain_kneser_ney(spark, docs_of):
    got = sums_of(docs_of([*enumerate(CORPUS), (99, CORPUS[0]), (100, None)]))
    assert [got[i] for i in range(len(CORPUS) - 1)] == pytest.approx(plain_sums(CORPUS)[:-1], abs=1e-3)
    assert got[99] == got[0] and not got[len(CORPUS) - 1] and not got[100]


def test_blocks_of_the_model_add_up(spark, docs_of, monkeypatch):
    docs = docs_of(list(enumerate(CORPUS)))
    docs = docs.unionByName(docs.withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 50))
    whole = sums_of(docs)
    monkeypatch.setattr(quality, "PART_ROWS", 16)
    monkeypatch.setattr(quality, "BLOCK_ROWS", 60)
    monkeypatch.setattr(quality, "PIECE", 7)
    cut = sums_of(docs)
    assert set(cut) == set(whole)
    for i in range(len(CORPUS) - 1):
        assert cut[i] == cut[i + 50] == pytest.approx(whole[i], abs=1e-3)


def test_probabilities_of_a_context_sum_to_less_than_one(spark, docs_of):
    docs = docs_of(list(enumerate(CORPUS)))
    known = quality.probabilities(quality.counted(docs, quality.scored(docs, ["doc_id"], "text", "lang", False)))
    rows = known.groupBy("_key", F.substring("gram", 1, 4).alias("c")).agg(F.sum("p").alias("p"), F.min("p").alias("least")).collect()
    assert all(0 < r["least"] and r["p"] <= 1 + 1e-9 for r in rows)


def test_counts_are_of_all_documents(spark, docs_of):
    docs = docs_of([(i, "ab" * (i + 1)) for i in range(30)]).repartition(5)
    got = {r["gram"]: r["n"] for r in quality.counted(docs, quality.scored(docs, [], "text", "lang", False)).collect()}
    texts = ["\x01" * 4 + "ab" * (i + 1) for i in range(30)]
    assert got == Counter(t[i - 4 : i + 1] for t in texts for i in range(4, len(t)))


def test_more_letters_than_fit_a_number():
    rng = random.Random(9)
    text = "".join(chr(rng.randint(0x3400, 0x9FFF)) for _ in range(60_000)) + "ab" * 20_000
    flat = quality.points([text])
    total = Counter()
    for piece in quality._pieces(flat):
        for grams, times in quality._spelled(piece):
            for gram, n in zip(map(tuple, grams.tolist()), times.tolist()):
                total[gram] += n
    points = plain_points(text)
    assert total == Counter(tuple(points[i - 4 : i + 1]) for i in range(4, len(points)))


def test_verdict_equals_plain_computation(spark, docs_of):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices(["the", "an", "er", "on", "re"], k=rng.randint(1, 3))) for _ in range(60)]
    corpus = [" ".join(rng.choices(vocabulary, k=rng.randint(55, 90))) for _ in range(40)] + ["".join(rng.choices("qxzjk 0123", k=400)) for _ in range(2)]
    judged = {r["doc_id"]: r for r in quality.judged(docs_of(list(enumerate(corpus))), ["doc_id"]).collect()}
    score = [-s / len(t) for s, t in zip(plain_sums(corpus), corpus)]
    passing = sorted(math.floor(s * 2000) for i, s in enumerate(score) if not judged[i]["base_failed"])
    middle = float(np.percentile(passing, 50))
    spread = max(1.4826 * float(np.percentile([abs(b - middle) for b in passing], 50)) / 2000, 0.01)
    for i, s in enumerate(score):
        inside = abs(s - (middle + 0.5) / 2000) <= 4 * spread + 0.5 / math.sqrt(len(corpus[i]))
        assert judged[i]["log_perplexity"] == pytest.approx(s, abs=1e-4)
        assert judged[i]["kept"] == (inside and not judged[i]["base_failed"])


def test_other_scripts_and_a_hundred_languages(spark, docs_of):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices(["\u043f\u0440\u043e", "\u0441\u0442\u043e", "\u043d\u0430", "\u043a\u043e", "\u0435\u0442"], k=rng.randint(1, 3))) for _ in range(200)]
    letters = [chr(c) for c in range(0x430, 0x450)]
    prose = [(i, " ".join(rng.choices(vocabulary, k=150))) for i in range(100)]
    shuffled = [(1000 + i, " ".join("".join(rng.sample(w, len(w))) for w in rng.choices(vocabulary, k=150))) for i in range(2)]
    noise = [(2000 + i, " ".join("".join(rng.choices(letters, k=6)) for _ in range(100))) for i in range(2)]
    many = [(3000 + i, t) for i, (_, t) in enumerate(prose)]
    docs = docs_of(prose + shuffled + noise + many)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 3000, F.lit("ru")).otherwise(F.concat(F.lit("x"), F.col("doc_id").cast("string"))))
    judged = {r["doc_id"]: r for r in quality.judged(docs, ["doc_id"]).collect()}
    assert len(judged) == 204 and sum(judged[i]["kept"] for i, _ in prose) >= 97
    assert not any(judged[i]["kept"] for i, _ in shuffled + noise)
    assert all(judged[i]["kept"] for i, _ in many)


def test_quality_query(spark, small, texts):
    got = {r["doc_id"]: r for r in QUERIES["op6_quality"](spark, small).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        r, want = got[doc], plain_statistics(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    passing = [r for r in got.values() if not r["base_failed"]]
    assert sum(r["kept"] for r in passing) >= 0.85 * len(passing)


def test_bands_reject_noise_and_keep_prose(spark, docs_of):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices(["the", "an", "er", "on", "re"], k=rng.randint(1, 3))) for _ in range(300)]
    prose = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 300)))) for i in range(300)]
    noise = [(1000 + i, "".join(rng.choices("qxzjkvwbp#$ 0123", k=900))) for i in range(5)]
    odd = [(2000, None), (2001, ""), (None, prose[0][1]), (2002, "word " * 500)]
    docs = docs_of(prose + noise + odd).selectExpr("*", "1 AS kept", "2 AS n_words", "3 AS _text")
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and not set(ids) & {r[0] for r in noise + odd[:2]} and 2002 not in ids
    assert len(set(ids) & {r[0] for r in prose}) >= 295
    nulls = docs.withColumn("lang", F.lit(None).cast("string"))
    assert quality.judged(nulls, ["doc_id"]).where("kept").count() >= 295
    assert quality.judged(docs_of([]), ["doc_id"]).count() == quality.accepted(docs_of([])).count() == 0


def grams(docs):
    return {r["gram"]: r["n"] for r in quality.counted(docs, quality.scored(docs, [], "text", "lang", False)).collect()}


def test_copies_move_neither_model_nor_band(spark, docs_of):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices(["the", "an", "er", "on", "re"], k=rng.randint(1, 3))) for _ in range(300)]
    prose = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 300)))) for i in range(300)]
    copies = [(1000 + i, prose[0][1]) for i in range(450)]  # with them, one text is well over half of the rows
    counts = lambda rows: grams(docs_of(rows).repartition(3))
    assert counts(prose + copies) == counts(prose)
    judged = lambda rows: {r["doc_id"]: r["kept"] for r in quality.judged(docs_of(rows), ["doc_id"]).collect()}
    alone, among = judged(prose), judged(prose + copies)
    assert len(among) == 750 and {d: among[d] for d in alone} == alone
    assert sum(alone.values()) >= 295 and {among[1000 + i] for i in range(450)} == {alone[0]}


def test_third_of_all_rows_is_one_text(spark, small, texts):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one = docs.where(F.col("doc_id") == texts[0][0]).crossJoin(spark.range(len(texts) // 2)).drop("id")
    judged = lambda df: dict(map(tuple, quality.judged(df, ["doc_id"]).select("doc_id", "kept").collect()))
    assert judged(docs.union(one)) == judged(docs)


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.trained(docs, labels.where("doc_id % 2 = 0"))
    assert list(model.thresholds) == sorted(model.thresholds)
    told = toxicity.severity(docs, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "y"), "doc_id").collect()
    caught = [r["toxic"] for r in told if r["y"] == 1]
    alarms = [r["toxic"] for r in told if r["y"] == 0]
    assert sum(caught) >= 0.6 * len(caught) and sum(alarms) <= 0.02 * len(alarms)
    for r in told:
        assert 0 <= r["expected_severity"] <= len(model.thresholds) and r["toxic"] == (r["grade"] > 0)


def plain_loss(weights, theta, x, grade):
    total = 0.0
    for row, g in zip(x, grade):
        score = sum(weights[c] * v for c, v in row.items())
        above = [1.0, *(1 / (1 + math.exp(t - score)) for t in theta), 0.0]
        total -= math.log(above[g] - above[g + 1])
    return total / len(x)


def test_fit_recovers_ordered_grades():
    rng = random.Random(1)
    x = [{0: float(rng.randint(0, 4)), 1: rng.random()} for _ in range(600)]
    grade = np.array([min(3, max(0, int(r[0] + rng.gauss(0, 0.6)))) for r in x])
    weights, theta = toxicity.fitted(x, grade, 2)
    best = plain_loss(weights, theta, x, grade)
    assert list(theta) == sorted(theta) and weights[0] > 5 * abs(weights[1])
    for change in (0.05, -0.05):
        assert plain_loss(weights * (1 + change), theta * (1 + change), x, grade) > best - 1e-3


def test_toxicity_of_odd_rows(spark, docs_of):
    bad = ["vile scum here", "such scum and trash", "trash talk", "scum trash vile"]
    rows = [(i, f"{bad[i % 4]} plain words number {i}") for i in range(40)] + [(100 + i, f"plain words number {i} and more") for i in range(80)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows] + [(None, 1), (5, None), (9999, 1), (3, 1)], "doc_id bigint, toxic int")
    docs = docs_of(rows + [(500, None), (501, ""), (502, "SCUM scum " * 30_000), (None, "trash scum"), (502, "vile scum trash")]).selectExpr("*", "1 AS toxic", "2 AS score", "3 AS _id", "4 AS _label", "5 AS _doc")
    model = toxicity.trained(docs, labels.selectExpr("*", "'x' AS text", "6 AS _doc"))
    got = toxicity.severity(docs, model).collect()
    assert len(got) == len(rows) + 5
    flagged = Counter(r["doc_id"] for r in got if r["toxic"])
    assert flagged[502] == 2 and flagged[None] == 1 and not flagged[500] and not flagged[501]
    assert toxicity.severity(docs_of([]), model).count() == 0
    for few in (labels.where("toxic = 1"), labels.where("toxic = 0"), labels.where("false")):
        nothing = toxicity.severity(docs, toxicity.trained(docs, few)).collect()
        assert len(nothing) == len(rows) + 5 and not any(r["toxic"] or r["score"] or r["expected_severity"] for r in nothing)
    assert toxicity.severity(docs_of([]), toxicity.trained(docs_of([]), labels)).count() == 0


def test_features_and_scores_equal_brute_force(spark, docs_of):
    rng = random.Random(8)
    bad, plain = ["vile", "scumbag", "trashy", "scummy"], [f"word{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(plain, k=20) + (rng.choices(bad, k=3) if i < 60 else []))) for i in range(200)]
    sample = toxicity.labelled(docs_of(rows), spark.createDataFrame([(i, int(i < 60)) for i, _ in rows], "doc_id bigint, toxic int"), "doc_id", "text", "toxic")
    counts = {1: Counter(), 0: Counter()}
    for i, text in rows:
        counts[int(i < 60)].update({f for w in text.split() for f in [w + "$", *(w[:n] for n in range(4, 9) if n <= len(w))]})
    want = {}
    for f, t in counts[1].items():
        c = counts[0][f]
        odds = math.log((t + 0.5) / (60 - t + 0.5)) - math.log((c + 0.5) / (140 - c + 0.5))
        errors = (t - (t + c) * 0.3) / math.sqrt((t + c) * 0.3 * 0.7)
        if t >= 4 and odds >= 2 and errors >= 6:
            want[f] = errors
    assert toxicity.kept_features(sample, 60, 140) == sorted(want, key=lambda f: (-want[f], f))
    model = toxicity.Severity({f: 0.5 + i for i, f in enumerate(want)}, (0.4, 2.0, 9.0))
    for r in toxicity.severity(docs_of(rows), model).collect():
        tally = Counter(f for w in rows[r["doc_id"]][1].split() for f in [w + "$", *(w[:n] for n in range(4, 9) if n <= len(w))] if f in want)
        score = sum(model.weights[f] * math.log1p(n) for f, n in tally.items())
        above = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert abs(r["score"] - score) < 1e-9 and abs(r["expected_severity"] - sum(above)) < 1e-9 and r["grade"] == sum(a >= 0.5 for a in above)


def test_long_texts_are_read_by_pieces(monkeypatch):
    text = " ".join(random.Random(3).choices("Ab cd, ef-gh ij".split(" "), k=500))
    whole = toxicity.word_counts(text)
    monkeypatch.setattr(toxicity, "_PIECE", 13)
    assert toxicity.word_counts(text) == whole
