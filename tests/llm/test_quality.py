import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import DOCUMENTS, documents

from caremesa.llm import quality

FOLDER = "/root/testdata/sf0.01"


def slow_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, repeated = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)], set(), 0
    for line in lines:
        repeated += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered), len(lines)


@pytest.mark.parametrize("text", [row[1] for row in DOCUMENTS if not row[1] or len(row[1]) < 5000] + ["a b c d e a b c d e f", "x\nx\n\nx \n x", "a " * 9, "q w e r t y q w e r t z q w e r t"])
def test_statistics(text):
    assert quality.text_statistics(text) == slow_statistics(text)


def test_chi_square():
    assert math.isclose(quality.chi2_quantile(0.05, 4), 9.4877, abs_tol=1e-3)
    assert math.isclose(quality.chi2_quantile(0.01, 6), 16.8119, abs_tol=1e-3)


def slow_estimates(vectors):
    """The same estimates from the single rows of a cell."""
    floor = np.array([quality.STEP * f for f in quality.FLOORS.values()])
    quarter, middle, three = np.percentile(vectors, [25, 50, 75], axis=0)
    centre, inverse = middle, np.diag(1 / np.maximum((three - quarter) / 1.349, floor) ** 2)

    def distance():
        off = vectors - centre
        return np.einsum("ij,jk,ik->i", off, inverse, off)

    def estimate(rows, share):
        own = vectors[rows]
        scatter = own.T @ own / len(own) - np.outer(own.mean(0), own.mean(0))
        return own.mean(0), np.linalg.inv(quality._consistency(share) * scatter + np.diag(floor**2))

    for _ in range(quality.STEPS):
        rings = np.floor(np.log2(1 + np.maximum(distance(), 0)) * 64)
        limit = np.sort(rings)[math.ceil(quality.H * len(rings)) - 1]
        centre, inverse = estimate(rings <= limit, quality.H)
    return estimate(distance() <= quality.chi2_quantile(0.025, 4), 0.975)


def test_verdicts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    cells, rows = defaultdict(list), {}
    for doc in docs:
        n, chars, symbols, dups, repeats, lines = stats = slow_statistics(doc["text"])
        failed = n < 10 or 100 * repeats > 20 * n
        vector = None
        if not failed:
            ratios = math.log(chars / n), math.sqrt(symbols / n), math.sqrt(dups / lines), math.sqrt(repeats / n)
            vector = np.array([math.floor(r * quality.STEP + 0.5) for r in ratios], float)
            for cell in ((doc["lang"], doc["source"]), (doc["lang"],), ()):
                cells[cell].append(vector)
        rows[doc["doc_id"]] = (stats, failed, vector, (doc["lang"], doc["source"]))
    known = {cell: slow_estimates(np.array(own)) for cell, own in cells.items() if len(own) >= quality.MIN_ROWS}
    limit, wrong = quality.chi2_quantile(quality.TAIL, 4), 0
    for row in quality.judge(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect():
        stats, failed, vector, cell = rows[row["doc_id"]]
        assert tuple(row)[1:6] == stats[:5] and row["base_failed"] == failed
        kept = not failed
        if kept:
            centre, inverse = next(known[key] for key in (cell, cell[:1], ()) if key in known)
            kept = (vector - centre) @ inverse @ (vector - centre) <= limit
        wrong += kept != row["kept"]
    assert wrong == 0


def test_outliers_go_and_clean_rows_stay(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    rows = quality.judge(docs).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_awkward_rows(spark):
    found = quality.judge(documents(spark)).collect()
    assert len(found) == len(DOCUMENTS)
    assert {r["doc_id"]: r["kept"] for r in found if r["doc_id"] in (1, 3, 4, 7)} == {1: True, 3: False, 4: False, 7: False}
    assert quality.judge(documents(spark).limit(0)).count() == 0
    kept = quality.keep(documents(spark))
    assert kept.columns == documents(spark).columns and kept.where("doc_id = 1").count() == 2


def prose(seed, n=120):
    """``n`` words without repeats of five."""
    draw = np.random.default_rng(seed)
    return ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), k)) for k in draw.choice([2, 3, 4, 5, 6, 8, 9], n)]


def test_a_third_of_junk_copies_does_not_hide_itself(spark):
    junk = " ".join(word + "###" for word in prose(0))
    rows = [(k, " ".join(prose(k)) if k % 3 else junk, "en", "hot") for k in range(300)]
    found = quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert {r["kept"] for r in found if r["doc_id"] % 3} == {True} and {r["kept"] for r in found if r["doc_id"] % 3 == 0} == {False}


def test_each_statistic_alone_can_reject(spark):
    lines = prose(1000, 30)
    draw = np.random.default_rng(1)
    passage = prose(1001, 9)
    extreme = {
        1000: " ".join(word * 5 for word in prose(1002)),
        1001: " ".join(word + "***" for word in prose(1003)),
        1002: "\n".join(draw.choice(lines, 600)),
        1003: " ".join(passage + prose(1004, 40) + passage + prose(1005, 37)),
    }
    rows = [(k, " ".join(prose(k)), "en", "a") for k in range(200)] + [(k, text, "en", "a") for k, text in extreme.items()]
    found = quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert not any(r["base_failed"] for r in found)
    assert {r["doc_id"] for r in found if not r["kept"]} == set(extreme)
