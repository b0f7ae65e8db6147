import hashlib
import random
import re

import duckdb
import pyarrow as pa
import pytest
from cases import DOCUMENTS, documents

from caremesa.llm import fim

TEXTS = [
    "one two three", "  lead and trail \t\n", " ", "x", "", None, "a <P> b", "c <S>", "<M>", "<P <S> x", "< P>", "é 漢字 🙂\x0bx\x0cy",
    "\x00 \x1c nul and separators", "a b c", "word " * 5_000, "<", "ends with <", "S> begins",
]


def slow(doc_id, text, rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in fim.MARKERS) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text, text)
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), output, text)


def test_equals_brute_force(spark):
    random.seed(13)
    texts = TEXTS * 12 + ["".join(random.choices("ab é🙂 \n\t<PSM>", k=random.randint(0, 60))) for _ in range(300)]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for rate, spm in ((50, 80), (100, 0), (100, 100), (0, 50)):
        moved = fim.transform(frame, rate=rate, spm=spm)
        back = fim.restore(moved, carry=moved.columns)
        assert sorted(map(tuple, back.collect())) == [slow(*row, rate, spm) for row in rows]


def test_query_on_awkward_rows(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found = sorted((tuple(r) for r in fim.digests(documents(spark)).collect()), key=repr)
    assert found == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in (slow(d, t) for d, t, *_ in DOCUMENTS)), key=repr)
    assert fim.digests(documents(spark).limit(0)).count() == 0


def test_sql_agrees(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 5)], "doc_id bigint, text string")
    documents = frame.toArrow()  # noqa: F841
    want = duckdb.sql(fim.ORACLE).fetchall()
    assert sorted(map(tuple, fim.digests(frame).collect())) == sorted(want)


def test_carried_columns_and_markers(spark):
    frame = spark.createDataFrame([(1, "one two", ["x"], 2.5)], "doc_id int, text string, tags array<string>, weight double")
    moved = fim.transform(frame, rate=100, markers=("[[pre]]", "[[suf]]", "[[mid]]"), carry=["doc_id", "tags", "weight"])
    assert moved.schema["tags"].dataType.simpleString() == "array<string>"
    row = fim.restore(moved, ("[[pre]]", "[[suf]]", "[[mid]]"), carry=["tags", "output"]).first()
    assert (row["tags"], row["restored"]) == (["x"], "one two") and "[[suf]]" in row["output"]
    for wrong in (("a", "a", "b"), ("ab", "a", "c"), ("xa", "ay", "z"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.transform(frame, markers=wrong)


def test_restore_of_nulls_and_broken_outputs(spark):
    rows = [(1, None, "psm"), (2, "x", None), (3, None, None), (4, "plain <P>", "plain")]
    frame = spark.createDataFrame(rows, "doc_id int, output string, form string")
    assert sorted(tuple(r) for r in fim.restore(frame).collect()) == [(1, None), (2, None), (3, None), (4, "plain <P>")]
    with pytest.raises(Exception, match="each marker once"):
        fim.restore(spark.createDataFrame([(1, "no markers", "psm")], "doc_id int, output string, form string")).collect()


def test_units_of_an_empty_batch():
    n, parts = fim.pieces(pa.array([], pa.binary()), pa.array([], pa.int64()), pa.array([], pa.int64()))
    assert len(n) == 0 and all(len(part) == 0 for part in parts)
