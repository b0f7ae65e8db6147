import math
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import DOCUMENTS, LONG, documents
from pyspark.sql import functions as F

from caremesa.llm import toxicity

FOLDER = "/root/testdata/sf0.01"
ENGLISH = "you are a real loser and an idiot too. the moron said it was stupid. worthless people do not own a house. disgusting trash. a clown is not pathetic. "


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.language_model(spark.createDataFrame([(ENGLISH * 50,), (None,), ("",)], "text string"))


def test_language_model_counts_all_texts(model):
    assert np.allclose(np.exp(model).sum(axis=2), 1, atol=1e-4)
    a, b, gap = 1, 2, 0
    assert model[gap][gap][a] > model[gap][gap][b]


@pytest.mark.parametrize(
    "written, meant",
    [
        ("you l0ser", "you loser"), ("a m o r o n", "a moron"), ("i.d.i.o.t!", "idiot"), ("stuuuupid", "stupid"), ("cl0wn tr@sh", "clown trash"),
        ("p@th3tic", "pathetic"), ("wor*hless", "worthless"), ("loser!!! house%%%", "loser house"), ("plain words stay", "plain words stay"), ("10.99.3.4", ""),
    ],
)
def test_deobfuscation(model, written, meant):
    restored = toxicity.Restorer(model).restore(written)
    assert restored == meant or written == "a m o r o n" and restored in ("a moron", "amoron")


def best_reading(model, columns):
    """All paths through a lattice."""
    paths = [("", 0.0)]
    for column in columns:
        paths = [(text + option, cost + more) for text, cost in paths for option, more in column]

    def score(text, cost):
        x = y = 0
        for code in toxicity._codes(text + " "):
            if code or y:
                cost += model[x][y][code]
                x, y = y, code
        return cost

    return max(score(text, cost) for text, cost in paths), {text: score(text, cost) for text, cost in paths}


@pytest.mark.parametrize("span", ["l0s3r", "1d10t", "st00pid", "$cum!!", "looooser"])
def test_viterbi_finds_the_best_path(model, span):
    restorer = toxicity.Restorer(model)
    best, scores = best_reading(restorer.model, restorer._lattice(span, False))
    found = restorer.decode(span, False).rstrip(" ")
    assert math.isclose(max(score for text, score in scores.items() if text.rstrip(" ") == found), best, abs_tol=1e-6)


def test_held_out_quarter(spark):
    rows = spark.range(100).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(row["h"] == (zlib.crc32(str(row["id"]).encode()) % 4 == 2) for row in rows)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity.score(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_disguised_words_are_caught(spark):
    base = [(i, f"you are such an even text, number {i}, and you know it well") for i in range(60)]
    bad = [(100 + i, f"you are such an idiot and you know it well, number {i}") for i in range(30)]
    new = [(500, "you are such an id1ot and an i d i o t"), (501, "you are such a nice person"), (502, None), (503, ""), (None, "text")]
    docs = spark.createDataFrame(base + bad + new, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0) for i, _ in base] + [(i, 1) for i, _ in bad] + [(None, 1), (500, None)], "doc_id bigint, toxic int")
    found = {row["doc_id"]: row for row in toxicity.score(docs, labels).collect()}
    assert found[500]["predicted"] == 1
    assert [found[i]["predicted"] for i in (501, 502, 503, None)] == [0] * 4
    assert found[None]["held_out"] is False


def test_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    found = toxicity.score(documents(spark), none).collect()
    assert len(found) == len(DOCUMENTS) and {row["predicted"] for row in found} == {0}
    assert toxicity.score(documents(spark).limit(0), none).count() == 0
    kept = toxicity.keep(documents(spark), none)
    assert kept.columns == documents(spark).columns and kept.count() == len(DOCUMENTS)


def test_long_spans(model):
    """A disguised word is read alike wherever it stands in a long token or a long spaced passage."""
    restorer = toxicity.Restorer(model)
    assert restorer.restore("l o s e r " * 300).replace(" ", "").count("loser") > 290
    assert "oo" in restorer.restore("0o" * 2_000)
    assert len(restorer.restore(LONG)) > len(LONG) * 0.9
    for lead in range(190, 211):
        assert restorer.restore("#" * lead + "l0ser").endswith("loser")
    for lead in range(380, 411, 2):
        assert restorer.restore("_ " * (lead // 2) + "m o r o n").replace(" ", "").endswith("moron")


RARE = {"zwarvok": 25, "plimdus": 9, "quorvex": 5, "drubnik": 3}


def test_rare_words_beside_a_text_with_many_copies(spark):
    """A third of the rows is one toxic text; others have telling words on 3 to 25 rows."""
    words = "even odd plain house garden river window letter story people market evening travel mountain".split()
    pick = lambda i, k: words[(i * 7 + k * 3 + i // 5) % len(words)]
    text = lambda i: f"text {i} about the {pick(i, 1)} and a {pick(i, 2)} near the {pick(i, 3)} of row {i * i}"
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    ids = iter(i for i in range(10_000) if not held(i))
    docs, labels = [], []

    def add(content, toxic):
        i = next(ids)
        docs.append((i, content))
        labels.append((i, toxic))

    for i in range(400):
        add(text(i), 0)
    for _ in range(300):
        add("you are a grumblewort and the whole copied passage says so again", 1)
    for word, n in RARE.items():
        for k in range(n):
            add(f"{text(500 + 40 * n + k)} {word}", 1)
    new = [(20_000 + 2 * k, f"a {word} it is") for k, word in enumerate(RARE)] + [(30_000, "the whole garden says so again"), (30_001, text(3))]
    frame = spark.createDataFrame(docs + new, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in toxicity.score(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert [found[20_000 + 2 * k]["predicted"] for k in range(len(RARE))] == [1] * len(RARE)
    assert [found[30_000]["predicted"], found[30_001]["predicted"]] == [0, 0]


def slow_cover(listed, marked):
    """The greedy choice with plain loops."""
    weights, chosen, left = [float(n) for _, n in marked], {}, set(range(len(listed)))
    bare = [feature.split("#")[0].lstrip("=") for feature, _, _ in listed]
    while left:
        net = {f: sum(w for (own, _), w in zip(marked, weights) if f in own) - (listed[f][2] - listed[f][1]) for f in left}
        best = max(left, key=lambda f: (net[f], len(listed[f][0]), listed[f][0]))
        if net[best] < toxicity.LEAST:
            break
        chosen[listed[best][0]] = (listed[best][1] + 0.5) / (listed[best][2] + 1)
        weights = [w / 2 if best in own else w for (own, _), w in zip(marked, weights)]
        left = {f for f in left if not bare[f].startswith(bare[best]) and not bare[best].startswith(bare[f])}
    return chosen


@pytest.mark.parametrize("seed", range(6))
def test_choice_equals_plain_loops(seed):
    rng = np.random.default_rng(seed)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(3, 7))) for _ in range(30)})
    names = sorted({f"{'=' if rng.random() < 0.3 else ''}{word}#{rng.integers(1, 3)}" for word in words for _ in range(2)})
    marked = [(sorted(rng.choice(len(names), rng.integers(0, 6), replace=False).tolist()), int(rng.integers(1, 5))) for _ in range(60)]
    listed = []
    for f, name in enumerate(names):
        t = sum(n for own, n in marked if f in own)
        listed.append((name, t, t + int(rng.integers(0, 2))))
    assert toxicity.cover(listed, marked) == slow_cover(listed, marked)
    assert toxicity.cover([], [([], 3)]) == {}


def test_scores_equal_a_slow_version(spark):
    """Features, choice and scores computed text by text, over whole tables, with the same language model."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    docs = docs.where("doc_id % 3 = 0").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    restorer = toxicity.Restorer(toxicity.language_model(docs))
    features = {text: toxicity.features(restorer.words(text)) for text in set(texts.values())}
    training = {}
    for i, label in toxic.items():
        training[texts[i]] = max(label, training.get(texts[i], 0))
    n, t = Counter(), Counter()
    for text, label in training.items():
        n.update(features[text])
        t.update(features[text] if label else ())
    listed = sorted((f, t[f], n[f]) for f in n if t[f] >= toxicity.SUPPORT and t[f] >= toxicity.PRECISION * n[f])
    numbers = {f: i for i, (f, _, _) in enumerate(listed)}
    marked = [(sorted(numbers[f] for f in features[text] if f in numbers), 1) for text, label in training.items() if label]
    chosen = slow_cover(listed, marked)
    missed = sum(not any(listed[f][0] in chosen for f in own) for own, _ in marked)
    base = min(0.25, (missed + 0.1) / (missed + max(1, len(training) - len(marked)) + 1))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels).collect()}
    for i, text in texts.items():
        clean = 1 - base
        for feature in features[text] & set(chosen):
            clean *= 1 - chosen[feature]
        assert math.isclose(found[i], 1 - clean, abs_tol=1e-9)


def test_columns_of_any_name_stay(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    frame = documents(spark).selectExpr("*", "0.123 as _score", "1 as score_", "2 as `a.b`")
    kept = toxicity.keep(frame, none)
    assert kept.columns == frame.columns and sorted(map(str, kept.collect())) == sorted(map(str, frame.collect()))
