"""Benchmark decontamination: a BM25 index of test items, searched by every training passage.

The test items are the indexed side; each passage of each document is a query.

* Items and texts are runs of letters and digits, A-Z lower-cased; in scripts without
  blanks each sign is a word.  An item is a
  question and an answer: two columns, or one text whose last line is the answer
  (a text of one line is a question without an answer).
* The index has BM25 impacts divided by the item's own score, so that a passage
  with all words of an item scores 1.  Items are indexed by length, each class
  up to a quarter longer than the one before; statistics are those of all items.
  Posting lists are cut into blocks with their largest impacts.
* Passages are windows of two cells; a cell is as long as an item of the class
  can be, so each item-long stretch of a document lies within one passage.
* Block-max WAND retrieves every item with a score of at least ``threshold``.
  Two bounds are made for many passages at once ahead of the walk.  Common terms,
  which are in most passages, add at most ``spare`` to any item's score, so the
  lists of the other terms must reach the threshold less ``spare`` together, or
  there is no pivot.  Then the largest impacts of up to 32 ranges of items tell
  whether any range can reach the threshold.  What is left walks its lists with
  pivots and block maxima.
* A retrieved item counts if at least ``overlap`` of the 5-word shingles of its
  question and of its answer are in the passage (parts of fewer than five words
  are one shingle of all their words).

Documents are read once and not shuffled.  Items reach the tasks in parts of about
``part_bytes`` of text, each an index of its own; what is beyond one part costs
further passes over the documents, not memory.  With several parts, Spark counts the
items that have each word, once, and each part gets the counts of its own words, so
the parts make no difference to the result.

Items of one to four words are no passage that BM25 could tell from ordinary text:
they are found, with score 1, where whole lines of a document hold just their words
in their order, question before answer.  Items without words are not searched for.
Null or empty texts hold nothing.  Items with equal texts are each reported.  Without
items, or documents, the result is empty.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.texts import LOWER, RUN, batches_of, owners, windows, word_hashes
from ledgerlark.session import landed

K1, B = 1.2, 0.75
THRESHOLD = 0.6
LENGTH_STEP = 1.25
OVERLAP = 0.8
WIDTH = 5
BLOCK_POSTINGS = 16
PART_BYTES = 8 << 20
SPARE = 0.3
RANGES = 32
_SLACK = 1e-6  # sums of maxima may fall short of the score itself by rounding

_CLASSES = np.where(RUN == 1, 1, 0).astype(np.uint8)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([t.translate(LOWER) for t in texts], _CLASSES, apart=True)


def _shingles(hashes: np.ndarray) -> np.ndarray:
    width = min(WIDTH, len(hashes))
    if width == 0:
        return np.zeros(0, np.uint64)
    return np.unique(windows(hashes, np.array([0, len(hashes)]), width)[0])


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item that is one text."""
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) < 2:
        return text, ""
    return "\n".join(lines[:-1]), lines[-1]


@dataclass
class Posting:
    items: np.ndarray  # ascending
    impacts: np.ndarray
    block_max: np.ndarray = field(init=False)
    most: float = field(init=False)

    def __post_init__(self):
        at = np.arange(0, len(self.items), BLOCK_POSTINGS)
        self.block_max = np.maximum.reduceat(self.impacts, at)
        self.most = float(self.impacts.max())


@dataclass
class Item:
    item_id: int
    parts: list[tuple[int, np.ndarray]]  # of question and answer: shingle width, distinct shingles
    impacts: dict[int, float]
    length: int


@dataclass
class Statistics:
    """Of all items of at least five words: their number, their words, and how many of them have a word."""

    n: int
    words: int
    df: dict[int, int]


def item_words(items: list[tuple[int, str, str]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(id, words of the question, words of the answer) of each item (id, question, answer)."""
    questions, q_at = tokens([q.encode() for _, q, _ in items])
    answers, a_at = tokens([a.encode() for _, _, a in items])
    for i, (item_id, _, _) in enumerate(items):
        yield item_id, questions[q_at[i] : q_at[i + 1]], answers[a_at[i] : a_at[i + 1]]


def weigh(items: list[tuple[int, str, str]], statistics: Statistics | None = None) -> list[Item]:
    """Items of at least five words, with BM25 impacts as shares of their own score.

    Without ``statistics``, these items are all there are.
    """
    chosen = []
    for item_id, question, answer in item_words(items):
        if len(question) + len(answer) >= WIDTH:
            parts = [(min(WIDTH, len(p)), _shingles(p)) for p in (question, answer)]
            chosen.append((item_id, parts, Counter(np.concatenate([question, answer]).tolist())))
    if statistics is None:
        df = Counter(t for _, _, bag in chosen for t in bag)
        statistics = Statistics(len(chosen), sum(sum(bag.values()) for _, _, bag in chosen), df)
    df, n, mean = statistics.df, statistics.n, statistics.words / max(1, statistics.n)
    out = []
    for item_id, parts, bag in chosen:
        length = sum(bag.values())
        norm = K1 * (1 - B + B * length / mean)
        impact = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + norm) for t, f in bag.items()}
        own = math.fsum(impact.values())
        out.append(Item(item_id, parts, {t: x / own for t, x in impact.items()}, length))
    return out


class Index:
    """Inverted index of weighed items; ``longest`` is the most words that an item of its class can have."""

    def __init__(self, items: list[Item], longest: int | None = None):
        self.ids = [i.item_id for i in items]
        self.parts = [i.parts for i in items]
        self.longest = longest or max(i.length for i in items)
        lists: dict[int, list[tuple[int, float]]] = {}
        for i, item in enumerate(items):
            for t, x in item.impacts.items():
                lists.setdefault(t, []).append((i, x))
        self.terms = np.array(sorted(lists), np.uint64)
        self.postings = [
            Posting(np.array([i for i, _ in lists[t]]), np.array([x for _, x in lists[t]])) for t in self.terms.tolist()
        ]
        self.most = np.array([p.most for p in self.postings])
        # Common terms: the most frequent ones, as long as no item gets more than SPARE from all of them.
        common, got = np.zeros(len(self.terms), bool), np.zeros(len(items))
        for t in sorted(range(len(self.terms)), key=lambda t: -len(self.postings[t].items)):
            posting = self.postings[t]
            if (got[posting.items] + posting.impacts).max() > SPARE:
                break
            got[posting.items] += posting.impacts
            common[t] = True
        self.spare = float(got.max(initial=0.0))
        self.leading = np.where(common, 0.0, self.most)
        width = -(-len(items) // RANGES)
        self.ranges = np.zeros((len(self.terms), -(-len(items) // width)), np.float32)
        for t, posting in enumerate(self.postings):
            np.maximum.at(self.ranges[t], posting.items // width, posting.impacts.astype(np.float32))
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(self.terms >> np.uint64(46)).astype(np.int64)] = True

    def terms_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and term numbers of the words that some item has."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(46)).astype(np.int64)])
        term = np.searchsorted(self.terms, hashes[at])
        term[term == len(self.terms)] = 0
        known = self.terms[term] == hashes[at]
        return at[known], term[known]


def indexes(items: list[tuple[int, str, str]], statistics: Statistics | None = None) -> list[Index]:
    """An index for each class of lengths; cells follow from the class alone, whichever items are in this part."""
    classes: dict[int, list[Item]] = {}
    for item in weigh(items, statistics):
        classes.setdefault(int(math.log(item.length) / math.log(LENGTH_STEP)), []).append(item)
    return [Index(c, math.ceil(LENGTH_STEP ** (k + 1))) for k, c in classes.items()]


class ShortItems:
    """Items of one to four words, by the hash of their words in order."""

    def __init__(self, items: list[tuple[int, str, str]]):
        self.by_length: dict[int, dict[int, list[tuple[int, tuple]]]] = {}
        for item_id, question, answer in item_words(items):
            words = np.concatenate([question, answer])
            if 0 < len(words) < WIDTH:
                key = int(windows(words, np.array([0, len(words)]), len(words))[0][0])
                self.by_length.setdefault(len(words), {}).setdefault(key, []).append((item_id, tuple(words.tolist())))

    def search(self, texts: list[bytes]) -> Iterator[tuple]:
        """Rows as of :func:`search_texts` for the items that stand on whole lines."""
        if not self.by_length:
            return
        lines = [t.split(b"\n") for t in texts]
        hashes, line_at = tokens([x for ls in lines for x in ls])
        places = line_at[np.cumsum([0, *map(len, lines)])]
        edge = np.zeros(len(hashes) + 1, bool)
        edge[line_at] = True
        owner, found = owners(places), set()
        for length, wanted in self.by_length.items():
            if len(hashes) < length:
                continue
            # Windows over all texts as one; those that reach into a second text are left out below.
            keys = windows(hashes, np.array([0, len(hashes)]), length)[0]
            begin = np.arange(len(keys))
            whole = edge[begin] & edge[begin + length] & (owner[begin] == owner[begin + length - 1])
            for at in np.flatnonzero(whole & np.isin(keys, np.array(list(wanted), np.uint64))).tolist():
                here = tuple(hashes[at : at + length].tolist())
                found.update((int(owner[at]), i) for i, words in wanted[int(keys[at])] if words == here)
        for row, item_id in sorted(found):
            yield row, item_id, 1.0, 1.0, 1.0


def block_max_wand(index: Index, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All items whose score for the distinct query terms reaches the threshold."""
    lists = [index.postings[t] for t in query]
    cursors = [[int(p.items[0]), k, 0] for k, p in enumerate(lists)]  # item, list, place
    heapq.heapify(cursors)
    found = []

    def advance(cursor: list[int], item: int) -> None:
        """Puts the list's cursor on its first posting at or behind the item."""
        posting = lists[cursor[1]]
        place = cursor[2] + int(np.searchsorted(posting.items[cursor[2] :], item))
        if place < len(posting.items):
            heapq.heappush(cursors, [int(posting.items[place]), cursor[1], place])

    while cursors:
        # Pivot: the first item at which the maxima of the lists up to it reach the threshold.
        passed, bound = [], 0.0
        while cursors and bound < threshold:
            passed.append(heapq.heappop(cursors))
            bound += lists[passed[-1][1]].most
        if bound < threshold:
            break
        pivot = passed[-1][0]
        while cursors and cursors[0][0] == pivot:
            passed.append(heapq.heappop(cursors))
        # The blocks that could hold the pivot bound its score more closely.
        close, until = 0.0, None
        for _, k, place in passed:
            posting = lists[k]
            at = place + int(np.searchsorted(posting.items[place:], pivot))
            if at < len(posting.items):
                block = at // BLOCK_POSTINGS
                close += float(posting.block_max[block])
                last = int(posting.items[min(len(posting.items), (block + 1) * BLOCK_POSTINGS) - 1])
                until = last if until is None else min(until, last)
        if close < threshold:
            # No item up to the nearest block end, or up to the next list's item, can reach it.
            skip = max(pivot + 1, until + 1) if until is not None else pivot + 1
            if cursors:
                skip = max(pivot + 1, min(skip, cursors[0][0]))
            for cursor in passed:
                advance(cursor, skip)
            continue
        score = 0.0
        for cursor in passed:
            posting = lists[cursor[1]]
            at = cursor[2] + int(np.searchsorted(posting.items[cursor[2] :], pivot))
            if at < len(posting.items) and posting.items[at] == pivot:
                score += float(posting.impacts[at])
        if score >= threshold:
            found.append((pivot, score))
        for cursor in passed:
            advance(cursor, pivot + 1)
    return found


def _overlap(part: tuple[int, np.ndarray], grams: dict[int, np.ndarray], passage: np.ndarray) -> float:
    width, wanted = part
    if not len(wanted):
        return 1.0
    if width not in grams:
        grams[width] = np.unique(windows(passage, np.array([0, len(passage)]), width)[0])
    return float(np.isin(wanted, grams[width], assume_unique=True).mean())


def search_texts(index: Index, words_of_texts: tuple, threshold: float, overlap: float) -> Iterator[tuple]:
    """(position of the text, item, score, question overlap, answer overlap), the best passage of each.

    ``words_of_texts`` are the texts as :func:`tokens` gives them.
    """
    hashes, places = words_of_texts
    if not len(hashes):
        return
    cell = index.longest
    words = np.diff(places)
    cells = np.maximum(1, -(-words // cell))
    first_cell = np.concatenate([[0], np.cumsum(cells)])
    at, term = index.terms_of(hashes)
    owner = owners(places)[at]
    of_cell = first_cell[owner] + (at - places[owner]) // cell
    leading = index.leading[term] > 0
    once = np.unique(of_cell[leading] * len(index.terms) + term[leading])
    bound = np.bincount(
        once // len(index.terms), weights=index.leading[once % len(index.terms)], minlength=first_cell[-1] + 1
    )
    pair = bound[:-1] + bound[1:]
    last_of_text = first_cell[1:] - 1
    pair[last_of_text] = bound[last_of_text]
    passages = np.flatnonzero(pair >= threshold - index.spare - _SLACK)
    if not len(passages):
        return
    row_of = np.searchsorted(first_cell, passages, side="right") - 1
    left = places[row_of] + (passages - first_cell[row_of]) * cell
    right = np.minimum(left + 2 * cell, places[row_of + 1])
    # Distinct terms of each of these passages, then the bounds of the ranges of items.
    begin, end = np.searchsorted(at, left), np.searchsorted(at, right)
    sizes = end - begin
    number = np.repeat(np.arange(len(passages)), sizes)
    hit = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
    once = np.unique(number * len(index.terms) + term[hit])
    number, queries = once // len(index.terms), once % len(index.terms)
    enough = np.bincount(number, index.leading[queries], minlength=len(passages)) >= threshold - index.spare - _SLACK
    number, queries = number[enough[number]], queries[enough[number]]
    begin = np.flatnonzero(np.diff(number, prepend=-1))
    if not len(begin):
        return
    bounds = np.add.reduceat(index.ranges[queries], begin, axis=0).max(axis=1)
    end = np.append(begin[1:], len(number))
    best: dict[tuple[int, int], tuple] = {}
    for k in np.flatnonzero(bounds >= threshold - _SLACK):
        passage, query = number[begin[k]], queries[begin[k] : end[k]]
        row, words_here = int(row_of[passage]), hashes[left[passage] : right[passage]]
        grams: dict[int, np.ndarray] = {}
        for item, score in block_max_wand(index, query, threshold):
            parts = [_overlap(p, grams, words_here) for p in index.parts[item]]
            if min(parts) >= overlap:
                best[row, item] = max(best.get((row, item), (0.0,)), (score, *parts))
    for (row, item), (score, question, answer) in best.items():
        yield row, index.ids[item], score, question, answer


def _search(held, threshold: float, overlap: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, statistics = held.value
        classes, short = indexes(items, statistics), ShortItems(items)
        for batch in batches:
            for part, texts in batches_of(batch):
                ids = part.column(part.schema.get_field_index("doc_id"))
                words = tokens(texts)
                found = [x for index in classes for x in search_texts(index, words, threshold, overlap)]
                found.extend(short.search(texts))
                columns = list(zip(*found, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(columns[0], pa.int64())),
                        pa.array(columns[1], pa.int64()),
                        *(pa.array(c, pa.float64()) for c in columns[2:]),
                    ],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

    return search


FOUND = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def _asked(row) -> tuple[int, str, str]:
    return (row["item_id"], *((row["q"], row["a"]) if row["a"] is not None else split_item(row["q"])))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, term, words of the item) for each distinct word of an item of at least five words; with its first one
    goes the number of its words, with the others 0."""
    for batch in batches:
        rows = batch.to_pylist()
        for row, (_, question, answer) in zip(rows, item_words([_asked(r) for r in rows]), strict=True):
            words = np.concatenate([question, answer])
            if len(words) >= WIDTH:
                term = np.unique(words).astype(np.int64)
                length = np.zeros(len(term), np.int64)
                length[0] = len(words)
                part = np.full(len(term), row["part"], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(term), pa.array(length)], names=["part", "term", "words"]
                )


def _statistics(items: DataFrame) -> Iterator[Statistics]:
    """For each part the statistics of all items, with the counts of the part's own words."""
    n_parts = items.agg(F.max("part")).first()[0] + 1
    terms = landed(items.mapInArrow(_item_terms, "part int, term bigint, words bigint"), "item_terms")
    total = terms.agg(F.count_if(F.col("words") > 0), F.coalesce(F.sum("words"), F.lit(0))).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    counts = landed(terms.select("part", "term").distinct().join(df, "term"), "item_counts")
    for part in range(n_parts):
        mine = counts.filter(F.col("part") == part).select("term", "df").toArrow()  # no more than the part's words
        of = dict(zip(mine["term"].to_numpy().astype(np.uint64).tolist(), mine["df"].to_pylist(), strict=True))
        yield Statistics(total[0], total[1], of)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row for each document and test item that it holds.

    ``items`` has item_id and either question and answer or text.
    """
    spark = docs.sparkSession
    if "question" in items.columns and "answer" in items.columns:
        cols = [F.coalesce("question", F.lit("")).alias("q"), F.coalesce("answer", F.lit("")).alias("a")]
    else:
        cols = [F.coalesce("text", F.lit("")).alias("q"), F.lit(None).cast("string").alias("a")]
    items = items.filter("item_id IS NOT NULL").select("item_id", *cols)
    size = items.agg(F.sum(F.octet_length("q") + F.coalesce(F.octet_length("a"), F.lit(0)))).first()[0] or 0
    n_parts = max(1, -(-size // part_bytes))
    of_part = F.pmod(F.xxhash64("item_id", "q", "a"), F.lit(n_parts)).cast("int")
    items = items.withColumn("part", of_part)
    # One part knows the statistics by itself.
    statistics = {0: None} if n_parts == 1 else dict(enumerate(_statistics(items)))
    out = None
    for part, known in statistics.items():
        mine = items.filter(F.col("part") == part).orderBy("item_id", "q", "a")
        held = spark.sparkContext.broadcast(([_asked(r) for r in mine.collect()], known))
        found = docs.select("doc_id", "text").mapInArrow(_search(held, threshold, overlap), FOUND)
        out = found if out is None else out.union(found)
    return out
