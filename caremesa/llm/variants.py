"""Operator 12: spelling variants by range searches in k-d trees over letter counts.

One inserted, deleted or replaced letter changes the letter counts of a word by at most two in
L1: up by one in at most one letter and down by one in at most one other. Words of each length
have a k-d tree over these vectors; a word searches the tree of its own length (a letter replaced)
and that of the next (a letter inserted), and a subtree is left out as soon as its box lies
further up or down than one edit reaches. What the counts leave is compared letter by letter.

A word's vector also holds the letter counts of its first half, by which one edit moves one letter
up and one down at most. So anagrams, whose whole counts are alike, have different places too.

On Spark, the upper part of a tree is fitted on a bounded sample and cuts a length into cells; every
word goes to its own cell and visits all cells that its box reaches. Each cell is one group of
bounded size: a cell with more residents or visitors than a group may hold becomes a grid of groups,
in which each resident meets each visitor once. The lower part of the tree is built in the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, settle

# The letters of a word, in the order of their columns.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(map(chr, range(0xC0, 0x100)))
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WIDTH = len(LETTERS)
_COLUMN = np.zeros(256, np.int64)
_COLUMN[[ord(letter) for letter in LETTERS]] = range(WIDTH)

#: Words and letters of a cell; visitors of a group; points of a leaf; words on which all upper trees are fitted.
CELL, CELL_LETTERS, VISITORS, LEAF, SAMPLE = 20_000, 2_000_000, 60_000, 192, 200_000
#: Sampled words for each cell, if the sample allows; pairs or letters that are compared at once; visitors that search a tree at once.
FIT, BLOCK, ASKED = 32, 1_000_000, 8_192

#: How far (up, down) the whole counts and the counts of the first half may lie from those of a visitor.
SAME, LONGER = (1, 1, 1, 1), (1, 0, 1, 1)

Node = int | tuple  # the number of a leaf, or (column, cut, node of counts up to the cut, node of those above)


def _room(length: Column, words: int | None = None, letters: int | None = None) -> Column:
    """How many words of a length a cell holds, or another number of words or letters."""
    by_letters = (F.lit(letters or CELL_LETTERS) / length).cast("int")
    return F.greatest(F.lit(LEAF), F.least(F.lit(words or CELL), by_letters))


def letters(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of one-byte letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def vectors(codes: np.ndarray, half: int) -> np.ndarray:
    """Letter counts of each row, then those of its first ``half`` letters, in the smallest type that holds the row's length."""
    counts = np.zeros((len(codes), 2 * WIDTH), np.min_scalar_type(-1 - codes.shape[1]))
    rows = np.arange(len(codes))
    for place in range(codes.shape[1]):
        column = _COLUMN[codes[:, place]]
        counts[rows, column] += 1
        if place < half:
            counts[rows, column + WIDTH] += 1
    return counts


def _split(points: np.ndarray, members: np.ndarray) -> tuple[int, int] | None:
    """The column and cut that halve these members best; whole counts first, None if nothing divides them."""
    if len(members) > 1024:
        members = members[:: len(members) // 512]  # a cut moves work only, never results
    points = points[members]
    middle = np.partition(points, len(points) // 2, axis=0)[len(points) // 2]
    best: tuple[float, int, int] = (0.0, 0, 0)
    for cut in (middle, middle - 1):
        low = (points <= cut).mean(axis=0)
        smaller = np.minimum(low, 1 - low)
        smaller[WIDTH:] *= 0.3
        column = int(smaller.argmax())
        best = max(best, (float(smaller[column]), column, int(cut[column])))
    return best[1:] if best[0] >= 0.02 else None


def grow(points: np.ndarray, leaf: int) -> tuple[Node, list[np.ndarray]]:
    """A tree whose leaves have at most ``leaf`` points, unless no cut divides them, and the points of each leaf."""
    leaves: list[np.ndarray] = []

    def node(members: np.ndarray) -> Node:
        cut = _split(points, members) if len(members) > leaf else None
        if cut:
            low = points[members, cut[0]] <= cut[1]
            if 0 < low.sum() < len(low):
                return (*cut, node(members[low]), node(members[~low]))
        leaves.append(members)
        return len(leaves) - 1

    return node(np.arange(len(points))), leaves


def home(tree: Node, points: np.ndarray) -> np.ndarray:
    """The leaf of each point."""
    found, stack = np.zeros(len(points), np.int64), [(tree, np.arange(len(points)))]
    while stack:
        node, members = stack.pop()
        if isinstance(node, int):
            found[members] = node
            continue
        low = points[members, node[0]] <= node[1]
        stack += [(node[2], members[low]), (node[3], members[~low])]
    return found


def reached(tree: Node, points: np.ndarray, limits: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """Each leaf whose box lies within ``limits`` of some of the points, and these points."""
    far = 1 << 30
    stack: list = [(tree, np.arange(len(points)), np.zeros((len(points), 4), np.int32), {})]
    while stack:
        node, members, used, box = stack.pop()
        if not len(members):
            continue
        if isinstance(node, int):
            yield node, members
            continue
        column, cut, low, high = node
        value, group = points[members, column].astype(np.int32), 2 * (column >= WIDTH)
        floor, ceiling = box.get(column, (-far, far))
        for child, side, more, bounds in (
            (low, group + 1, np.maximum(value - cut, 0) - np.maximum(value - ceiling, 0), (floor, cut)),
            (high, group, np.maximum(cut + 1 - value, 0) - np.maximum(floor - value, 0), (cut + 1, ceiling)),
        ):
            total = used[:, side] + more
            near = total <= limits[side]
            spent = used[near]
            spent[:, side] = total[near]
            stack.append((child, members[near], spent, {**box, column: bounds}))


def _one_edit(residents: np.ndarray, visitors: np.ndarray) -> np.ndarray:
    """Row by row, whether a resident is the visitor with exactly one letter replaced or, if longer, inserted."""
    if residents.shape[1] == visitors.shape[1]:
        return (residents != visitors).sum(axis=1) == 1
    front, back = residents[:, :-1] == visitors, (residents[:, 1:] == visitors)[:, ::-1]
    size = visitors.shape[1]
    before = np.where(front.all(axis=1), size, front.argmin(axis=1))
    return before + np.where(back.all(axis=1), size, back.argmin(axis=1)) >= size


def pairs(residents: np.ndarray, visitors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of residents and visitors (rows of letters, as long or one shorter) that are one edit apart, each pair once."""
    length = residents.shape[1]
    half, exact = length // 2, np.float32 if length <= 1000 else np.float64
    points = vectors(residents, half)
    tree, leaves = grow(points, LEAF)
    used = points.any(axis=0)
    limits = SAME if visitors.shape[1] == length else LONGER
    apart = sum(limits)  # letters up or down by one: squared distance and L1 distance are equal
    held = points[:, used].astype(exact)
    norms = np.einsum("ij,ij->i", held, held)
    for begin in range(0, len(visitors), ASKED):
        block = visitors[begin : begin + ASKED]
        asked = vectors(block, half)
        mine = asked[:, used].astype(exact)
        size = np.einsum("ij,ij->i", asked, asked, dtype=exact)
        for leaf, members in reached(tree, asked, limits):
            own = leaves[leaf]
            for here in np.array_split(members, 1 + len(members) * len(own) // BLOCK):
                for there in np.array_split(own, 1 + len(here) * len(own) // BLOCK):
                    distance = size[here, None] + norms[there] - 2 * (mine[here] @ held[there].T)
                    one, two = np.nonzero(distance < apart + 0.5)
                    step = max(1, BLOCK // length)
                    for part in range(0, len(one), step):
                        v, r = here[one[part : part + step]], there[two[part : part + step]]
                        true = _one_edit(residents[r], block[v])
                        yield r[true], begin + v[true]


class Best:
    """For some words, how many near words they have and the best of them: most frequent, then smallest."""

    def __init__(self, words: np.ndarray, counts: np.ndarray) -> None:
        self.words, self.counts = words, counts
        self.order = np.lexsort((words, -counts))
        self.place = np.empty(len(words), np.int64)
        self.place[self.order] = np.arange(len(words))
        self.near, self.best = np.zeros(len(words), np.int64), np.full(len(words), len(words))

    def add(self, words: np.ndarray, others: np.ndarray) -> None:
        self.near += np.bincount(words, minlength=len(self.words))
        np.minimum.at(self.best, words, self.place[others])

    def rows(self) -> pd.DataFrame:
        found = np.nonzero(self.near)[0]
        form = self.order[self.best[found]]
        return pd.DataFrame({"word": self.words[found], "n_near": self.near[found], "form_n": self.counts[form], "form": self.words[form]})


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """Near words within one group; a visitor that is as long as the residents counts for itself only, as it lives in a cell too."""
    words, counts, visits = group["word"].to_numpy(object), group["n"].to_numpy(np.int64), group["visits"].to_numpy(bool)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    best, residents = Best(words, counts), np.nonzero(~visits)[0]
    length = int(sizes[residents[0]]) if len(residents) else 0
    for own in (length, length - 1):
        visitors = np.nonzero(visits & (sizes == own))[0]
        if len(residents) and len(visitors):
            for r, v in pairs(letters(list(words[residents]), length), letters(list(words[visitors]), own)):
                best.add(visitors[v], residents[r])
                if own < length:
                    best.add(residents[r], visitors[v])
    return best.rows()


def _trees(words: DataFrame) -> dict[int, Node]:
    """The upper trees of the lengths that have more words than a cell holds, fitted on at most about ``SAMPLE`` words."""
    length = F.length("word")
    sizes = words.groupBy(length.alias("length")).count().filter(c("count") > _room(c("length")))
    large = {row["length"]: row["count"] / row["room"] for row in sizes.withColumn("room", _room(c("length"))).collect()}
    wanted = FIT * sum(large.values())
    if not large:
        return {}
    scale = min(1.0, SAMPLE / wanted)
    draw = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) / float(1 << 30)
    sample = words.filter(length.isin(*large)).filter(draw < scale * FIT / _room(length)).select("word").toPandas()["word"]
    trees = {}
    for size, own in sample.groupby(sample.str.len()):
        size = int(size)
        codes = letters(list(own), size)
        leaf = max(2, round(len(own) / large[size]))
        trees[size] = grow(vectors(codes, size // 2), leaf)[0]
    return trees


def near_words(words: DataFrame) -> DataFrame:
    """Near words of each row of ``words`` (word, n): n_near, form_n and form, the best near word. Words without any are left out.

    ``words`` holds each word once, of letters ``[A-Za-z\\u00C0-\\u00FF]`` and not empty.
    """
    trees = _trees(words)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["word"].str.len()
            for size, own in batch.groupby(sizes):
                size = int(size)
                codes = letters(list(own["word"]), size)
                for target, limits in ((size, SAME), (size + 1, LONGER)):
                    tree = trees.get(target, 0)
                    points = vectors(codes, target // 2) if target in trees else np.zeros((len(codes), 0))
                    if target == size:
                        yield own.assign(length=target, cell=home(tree, points), visits=False)
                    for cell, members in reached(tree, points, limits):
                        yield own.iloc[members].assign(length=target, cell=cell, visits=True)

    kinds = "word string, n bigint, length int, cell int, visits boolean"
    routed = settle(words.select("word", "n").mapInPandas(route, kinds))
    own, guests = F.sum(F.when(c("visits"), 0).otherwise(1)), F.sum(F.when(c("visits"), 1).otherwise(0))
    most = _room(c("length"), VISITORS, 4 * CELL_LETTERS)
    cells = (
        routed.groupBy("length", "cell").agg(own.alias("own"), guests.alias("guests")).filter("own > 0 and guests > 0")
        .select(
            c("length").alias("_length"), c("cell").alias("_cell"),
            F.ceil(c("own") / (2 * _room(c("length")))).cast("int").alias("_parts"), F.ceil(c("guests") / most).cast("int").alias("_salts"),
        )
    )
    dealt = routed.join(cells, (c("length") == c("_length")) & (c("cell") == c("_cell")))
    lot = lambda ways: F.pmod(F.xxhash64("word"), ways).cast("int")
    all_of = lambda ways: F.sequence(F.lit(0), ways - 1)
    grid = (
        dealt.withColumn("part", F.explode(F.when(c("visits"), all_of(c("_parts"))).otherwise(F.array(lot(c("_parts"))))))
        .withColumn("salt", F.explode(F.when(c("visits"), F.array(lot(c("_salts")))).otherwise(all_of(c("_salts")))))
        .select("length", "cell", "part", "salt", "word", "n", "visits")
    )
    met = grid.groupBy("length", "cell", "part", "salt").applyInPandas(_meet, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-c("form_n")).alias("rank"), c("form").alias("form")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-c("_best.rank")).alias("form_n"), c("_best.form").alias("form")
    )


def count_words(docs: DataFrame, min_chars: int = 5, min_count: int = 3, slips: int = 0) -> DataFrame:
    """word and n of all distinct words of the column ``text`` with at least ``min_chars`` letters and ``min_count`` occurrences.

    A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z in lower case. With ``slips``, a run loses a letter
    when that number divides the CRC-32 of ``doc_id:run``; the same number picks the letter. A null doc_id counts as empty.
    """
    found = F.regexp_extract_all(F.coalesce(c("text"), F.lit("")), F.lit(f"{RUN}{{{min_chars},}}"), F.lit(0))
    runs = docs.select("doc_id", F.explode(found).alias("word")).withColumn("word", F.translate("word", UPPER, LOWER))
    if slips:
        code = F.crc32(F.concat(F.coalesce(c("doc_id").cast("string"), F.lit("")), F.lit(":"), c("word")))
        runs = runs.select("word", code.alias("_code"))
        place = (c("_code") % F.length("word")).cast("int")
        shorter = F.concat(F.substring(c("word"), F.lit(1), place), F.substring(c("word"), place + 2, F.length("word")))
        runs = runs.select(F.when(c("_code") % slips == 0, shorter).otherwise(c("word")).alias("word")).filter(F.length("word") >= min_chars)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(c("n") >= min_count)


def roots(forms: DataFrame) -> DataFrame:
    """word and the last word reached by following ``form``, for rows with a form; each round doubles the steps taken.

    The forms must not lead in a circle.
    """
    chains = settle(forms.filter(c("form").isNotNull()).select("word", c("form").alias("root"), F.lit(True).alias("moved")))
    while not chains.filter("moved").isEmpty():
        ahead = chains.select(c("word").alias("_at"), c("root").alias("_next"))
        chains = settle(
            chains.join(ahead, c("root") == c("_at"), "left")
            .select("word", F.coalesce("_next", "root").alias("root"), c("_next").isNotNull().alias("moved"))
        )
    return chains.select("word", "root")


def group(docs: DataFrame, min_chars: int = 5, min_count: int = 3, factor: int = 2, slips: int = 0) -> DataFrame:
    """Groups spelling variants of all words of ``docs`` that are long and frequent enough.

    Two words are near if one inserted, deleted or replaced letter makes them equal. A
    word's form is its near word with the largest n (ties: the smallest in code-point
    order) if that n is at least ``factor`` (2 or more) times its own. Returns word, n, form, root (the last
    form that is reached; the word itself without a form), n_near and form_n.

    Nulls: a null text has no words, a null doc_id is an empty id. Empty texts give
    nothing, long texts and long runs are read whole, repeated rows count each time.
    Without words there are no rows. Other columns are ignored, whatever their names.
    """
    if factor < 2:
        raise ValueError("forms could lead in a circle")
    words = settle(count_words(docs, min_chars, min_count, slips))
    found = near_words(words).withColumnRenamed("word", "_word")
    joined = words.join(found, c("word") == c("_word"), "left")
    formed = c("form_n") >= factor * c("n")
    forms = settle(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, c("form")).alias("form"), F.when(formed, c("form_n")).alias("form_n")
    ))
    ends = roots(forms).withColumnRenamed("word", "_word")
    return forms.join(ends, c("word") == c("_word"), "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )


ORACLE = r"""
with recursive given as (
    select distinct doc_id, lower_run, count(*) over (partition by doc_id, lower_run) as times
    from (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{5,}')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_run from documents)
), crc_table as (
    select list_transform(range(256), lambda b: list_reduce(range(8), lambda a, i:
        case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, b)) as entries
), bytes as (
    select doc_id, lower_run, times, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || lower_run, ''), lambda s:
        case when unicode(s) < 128 then [unicode(s)::bigint] else [(192 | (unicode(s) >> 6))::bigint, (128 | (unicode(s) & 63))::bigint] end)) as codes
    from given
), coded as (
    select lower_run, times, xor(list_reduce(codes, lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) as h
    from bytes, crc_table
), words as (
    select word, sum(times)::bigint as n
    from (
        select times, case when h % 97 = 0 then substr(lower_run, 1, (h % length(lower_run))::integer) || substr(lower_run, (h % length(lower_run))::integer + 2)
            else lower_run end as word
        from coded
    )
    where length(word) >= 5 group by word having sum(times) >= 3
), cuts as (
    select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1))::integer as i from words)
), near as (
    select a.word, b.word as other, b.n from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select c.word, w.word, w.n from cuts c join words w on c.rest = w.word
    union select w.word, c.word, c.n from cuts c join words w on c.rest = w.word
), best as (
    select word, count(*) as n_near, arg_min(other, (-n, other)) as other, max(n) as other_n from near group by word
), formed as (
    select words.word, n, case when other_n >= 2 * n then other end as form, coalesce(n_near, 0)::bigint as n_near,
        case when other_n >= 2 * n then other_n end as form_n
    from words left join best on words.word = best.word
), steps as (
    select word, word as place, form as ahead, 0 as depth from formed
    union all
    select steps.word, formed.word, formed.form, depth + 1 from steps join formed on formed.word = steps.ahead
)
select formed.word, n, form, place as root, n_near, form_n
from formed join steps on formed.word = steps.word and steps.ahead is null
"""
