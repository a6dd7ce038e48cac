"""Scoring texts with a language model learned from the corpus.

Counts come from every training text: words for the base score, subword ids and
which id follows which for the output shares of the attention model. The
model's weights are trained where the data lies: each round, every task goes
over its own windows from the same weights, and the tasks' weights are averaged
by the number of windows. All windows of all training texts are trained on, half
of them in each round; a caller may ask for ``rounds`` of every ``every`` windows,
from a seeded place of each text.

Scoring cuts a text's ids into overlapping windows, in which each id is scored
once with the ids before it as context.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from camlytics.llm import attention
from camlytics.llm.common import id_remainder, long_rows, mix, most_counted, slices, stored, text_bytes, worker_memory

FOLDS, HELD_OUT = 7, 2
EVERY, ROUNDS = 2, 2
#: Words whose counts every task holds; the counts of rarer words are joined.
TOP_WORDS = 1 << 17
#: Words whose ids a Python worker remembers before it starts anew.
KNOWN_WORDS = 400_000
#: Text whose windows are one block of training, and text that is held as words and ids at a time.
BATCH_BYTES, HELD_BYTES = 4 << 20, 1 << 20
#: Counts of words that a task adds up before they are shuffled.
HELD_COUNTS = 1 << 17
#: Rows read and handed to a Python worker at a time: texts, and blocks of windows; and counts it hands back at a time.
TEXT_ROWS, BLOCK_ROWS, COUNT_ROWS = 1000, 2, 1 << 15


class _Pieces:
    """Subword ids of words, remembered per Python worker in one array."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = self.model.get_piece_size(), self.model.eos_id()
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.at = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        self.table, self.counts = "", np.zeros(0, dtype=np.int64)

    def counted(self, table: str, counts: dict[str, int]) -> np.ndarray:
        """Count of each remembered word in the table of that name, -1 where it has none."""
        if self.table != table:
            self.table, self.counts = table, np.zeros(0, dtype=np.int64)
        new = len(self.index) - len(self.counts)
        if new:
            words = islice(self.index, len(self.counts), None)
            added = np.fromiter((counts.get(w, -1) for w in words), dtype=np.int64, count=new)
            self.counts = np.concatenate([self.counts, added])
        return self.counts

    def of(self, words: list[str]) -> np.ndarray:
        """Number n of each distinct word: its ids are ``ids[at[n]:at[n + 1]]``."""
        if len(self.index) > KNOWN_WORDS:
            self._forget()
        places = [self.index.get(w, -1) for w in words]
        new = [w for w, p in zip(words, places) if p < 0]
        lists: list[list[int]] = []
        for at in range(0, len(new), 4096):
            lists += self.model.encode(new[at : at + 4096], num_threads=1)
        if new:
            start = len(self.index)
            sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=sizes.sum())])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.index.update(zip(new, range(start, start + len(new))))
        out = np.array(places, dtype=np.int64)
        out[out < 0] = np.arange(len(self.index) - len(new), len(self.index))
        return out

    def sequence(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words of these numbers, one after the other, and where each word begins."""
        sizes = np.diff(self.at)[numbers]
        first = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(self.at[:-1][numbers] - first[:-1], sizes) + np.arange(first[-1])], first


def _pieces(path: str) -> _Pieces:
    loaded = worker_memory("pieces")
    if path not in loaded:
        loaded[path] = _Pieces(path)
    return loaded[path]


def _emptied() -> None:
    """Give back what this worker remembers of earlier tasks and does not need now."""
    worker_memory("pieces").clear()
    pa.default_memory_pool().release_unused()


def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-cased words of the texts, each distinct one held once, and where each text's words begin."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, at = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(flat, "")
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full).dictionary_encode(), kept[at - at[0]]


def _with_ends(pieces: _Pieces, words: pa.DictionaryArray, first: np.ndarray, numbers=None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text with the end at its end, and where each text begins."""
    ids, at = pieces.sequence(pieces.of(words.dictionary.to_pylist())[words.indices.to_numpy()] if numbers is None else numbers)
    begins = at[first]
    return np.insert(ids, begins[1:], pieces.end), begins + np.arange(len(begins))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of about ``size`` bytes of text together, however the batches are cut.

    Texts are the last column; an empty one counts as much as a short window.
    """
    held, number, total = [], 0, 0
    for batch in batches:
        ends = total + np.cumsum(np.diff(text_bytes(batch.column(batch.num_columns - 1))[1]) + attention.WINDOW)
        start, total = 0, int(ends[-1]) if len(ends) else total
        for edge in np.flatnonzero(np.diff(ends // size, prepend=number)).tolist():
            held.append(batch.slice(start, edge - start))
            if sum(map(len, held)):
                yield pa.concat_batches(held)
            held, start = [], edge
        held.append(batch.slice(start))
        number = total // size
    if sum(map(len, held)):
        yield pa.concat_batches(held)


def _added(counts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(counts).group_by("word", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
    return pa.record_batch({"word": pa.concat_arrays(table["word"].chunks), "n": pa.concat_arrays(table["n_sum"].chunks)})


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch.column(0), HELD_BYTES):
            words, _ = _split(part)
            n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            held.append(pa.record_batch({"word": words.dictionary.cast(pa.string()), "n": pa.array(n.astype(np.int64))}))
            if sum(map(len, held)) > HELD_COUNTS:
                yield _added(held)
                held = []
    if sum(map(len, held)):
        yield _added(held)


def _count_ids(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        total = np.zeros(pieces.size, dtype=np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy()
            ids, at = pieces.sequence(pieces.of(batch.column(0).to_pylist()))
            total += np.bincount(ids, weights=np.repeat(n, np.diff(at)), minlength=pieces.size).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    return count


_WINDOWS = "cell int, n long, round int, ids binary"


def _held_as(pieces: _Pieces) -> type:
    """The smallest numbers that hold every id and -1."""
    return np.int16 if pieces.size <= 1 << 15 else np.int32


def _windows(path: str, vocabulary, every: int, rounds: int):
    """Counts of which id follows which, over all texts, and the ids of the training windows of each round."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = _pieces(path), vocabulary.value
        total = np.zeros((attention.INPUTS + 1) * attention.FOLLOWERS, dtype=np.int64)
        for block in _blocks(batches, BATCH_BYTES):
            # Windows at even distances, from a place that the text's hash decides, dealt to the rounds in turn.
            shifts = (mix(block.column(0).to_numpy().view(np.uint64)) % np.uint64(every)).astype(np.int64)
            done, held = 0, []
            for part in slices(block.column(1), HELD_BYTES):
                words, first = _split(part)
                ids, begins = _with_ends(pieces, words, first)
                before = np.concatenate([[attention.BEGIN], known.inputs[ids[:-1]]]) if len(ids) else np.zeros(0, int)
                before[begins[:-1][begins[:-1] < len(ids)]] = attention.BEGIN
                cells = attention.cell(known, before, ids)
                total += np.bincount(cells[cells >= 0], minlength=len(total))
                shift = shifts[done : done + len(part)]
                done += len(part)
                _, new, _ = attention.windows(
                    ids, begins, known.inputs, lambda place, text: (place + shift[text]) % (every // rounds) == 0
                )
                held.append(new.astype(_held_as(pieces)))
            block_windows = np.concatenate(held)
            for r in range(rounds):
                mine = block_windows[r::rounds]
                yield pa.record_batch({
                    "cell": pa.nulls(1, pa.int32()), "n": pa.array([len(mine)], pa.int64()),
                    "round": pa.array([r], pa.int32()), "ids": pa.array([mine.tobytes()], pa.binary()),
                })
        found = np.flatnonzero(total)
        for at in range(0, len(found), COUNT_ROWS):
            seen = found[at : at + COUNT_ROWS]
            yield pa.record_batch({
                "cell": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen]),
                "round": pa.nulls(len(seen), pa.int32()), "ids": pa.nulls(len(seen), pa.binary()),
            })

    return emit


def _trained(held_as: type, vocabulary, weights, seed: int):
    """The weights after one pass over the task's windows, times the number of windows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _emptied()
        own, done = weights.value, 0
        total = np.zeros(len(own))
        for batch in batches:
            for held in batch.column(0):
                ids = np.frombuffer(held.as_py(), dtype=held_as).astype(np.int32).reshape(-1, attention.WINDOW)
                rows = np.where(ids < 0, attention.BEGIN, vocabulary.value.inputs[ids])
                if len(rows):
                    # Later parts of a task's windows move the weights less, like a decaying rate.
                    own = attention.train(own, vocabulary.value, rows, ids, seed=seed)
                    total += own * len(rows)
                    done += len(rows)
        if done:
            yield pa.record_batch({
                "place": pa.array(np.arange(len(own), dtype=np.int32)), "value": pa.array(total),
                "n": pa.array(np.full(len(own), done, dtype=np.int64)),
            })

    return emit


class Model:
    """What scoring needs: vocabulary with shares, weights, and the training counts of words."""

    def __init__(self, path, vocabulary, weights, words: DataFrame, top: dict, tokens: int, kinds: int, texts: int):
        self.path, self.vocabulary, self.weights, self.words = path, vocabulary, weights, words
        self.top, self.tokens, self.kinds, self.texts = top, tokens, kinds, texts


def fit(docs: DataFrame, path: str, every: int = EVERY, rounds: int = ROUNDS, seed: int = 0) -> Model:
    """A model of the texts in column ``body`` of all rows."""
    spark = docs.sparkSession
    counted = docs.select("body").mapInArrow(_count_words, "word string, n long")
    with long_rows(spark, TEXT_ROWS):
        words = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    texts = docs.select(F.count(F.lit(1)).alias("n")).first()["n"]
    tokens, kinds = (sums["n"] or 0) + texts, sums["v"] + (1 if texts else 0)
    # Bounded: TOP_WORDS words, the ids of the tokenizer, FOLLOWERS cells per input row, one number per weight.
    top = most_counted(words, TOP_WORDS).toArrow()
    by_id = words.mapInArrow(_count_ids(path), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    pieces = _pieces(path)
    counts = np.zeros(pieces.size, dtype=np.int64)
    counts[by_id["id"].to_numpy(dtype=np.int64)] = by_id["n"].to_numpy(dtype=np.int64)
    counts[pieces.end] += texts
    vocabulary = attention.vocabulary(counts)
    shared = spark.sparkContext.broadcast(vocabulary)
    windows = docs.select(F.xxhash64(F.lit(seed), "body"), "body").mapInArrow(_windows(path, shared, every, rounds), _WINDOWS)
    with long_rows(spark, TEXT_ROWS):
        windows = stored(windows, "windows")
    cells = windows.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    weights = attention.start(vocabulary, seed)
    for r in range(rounds):
        given = spark.sparkContext.broadcast(weights)
        held = windows.where((F.col("round") == r) & (F.col("n") > 0)).select("ids")
        summed = held.mapInArrow(_trained(_held_as(pieces), shared, given, seed + r), "place int, value double, n long").groupBy("place")
        with long_rows(spark, BLOCK_ROWS):
            mean = summed.agg((F.sum("value") / F.sum("n")).alias("w")).toPandas()
        if len(mean):
            weights = np.empty(len(weights))
            weights[mean["place"].to_numpy(dtype=np.int64)] = mean["w"].to_numpy()
    vocabulary = attention.followed(vocabulary, cells["cell"].to_numpy(dtype=np.int64), cells["n"].to_numpy(dtype=np.float64))
    held = dict(zip(top["word"].to_pylist(), top["n"].to_pylist()))
    return Model(path, vocabulary, weights, words, held, tokens, kinds, texts)


_SCORED = (
    "struct<n_tokens: bigint, n_known: bigint, base_score: double, score: double, rare: array<struct<word: string, n: bigint>>>"
)


def _scorer(path: str, vocabulary, weights, top, denominator: int, end_count: int):
    table = uuid.uuid4().hex

    def scored(texts: pa.Array) -> pa.Array:
        pieces, known, p, counts = _pieces(path), vocabulary.value, attention.split(weights.value), top.value
        columns: list[list[np.ndarray]] = [[], [], [], []]
        rare_words, rare_n, rare_sizes = [], [], []
        for part in slices(texts, HELD_BYTES):
            words, first = _split(part)
            distinct, index = words.dictionary.to_pylist(), words.indices.to_numpy()
            numbers = pieces.of(distinct)
            c = pieces.counted(table, counts)[numbers]
            logs = np.where(c >= 0, np.log10((np.maximum(c, 0) + 1) / denominator), 0.0)
            number = np.diff(first)
            sums = np.concatenate([[0.0], np.cumsum(logs[index])])[first]
            hits = np.concatenate([[0], np.cumsum(c[index] >= 0)])[first]
            rows, ids, windows = attention.windows(*_with_ends(pieces, words, first, numbers[index]), known.inputs)
            scores = np.concatenate([[0.0], np.cumsum(attention.log_probability(p, known, rows, ids))])
            ends = np.concatenate([[0], np.cumsum(windows)])
            columns[0].append(number + 1)
            columns[1].append(np.diff(hits) + (1 if end_count else 0))
            columns[2].append(np.diff(sums) + np.log10((end_count + 1) / denominator))
            columns[3].append(np.diff(scores[ends]) / np.log(10))
            # Words beyond the top: their counts are joined later.
            at = np.flatnonzero(c[index] < 0)
            owner = np.searchsorted(first, at, side="right") - 1
            pairs, n = np.unique(owner * max(1, len(distinct)) + index[at], return_counts=True)
            owner, word = np.divmod(pairs, max(1, len(distinct)))
            rare_words.append(words.dictionary.cast(pa.string()).take(pa.array(word, pa.int64())))
            rare_n.append(n)
            rare_sizes.append(np.bincount(owner, minlength=len(part)))

        def joined(arrays):
            return np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)

        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(joined(rare_sizes))]), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.concat_arrays(rare_words) if rare_words else pa.array([], pa.string()), pa.array(joined(rare_n), pa.int64())],
                names=["word", "n"],
            ),
        )
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.StructArray.from_arrays(
            [*[pa.array(joined(c), k) for c, k in zip(columns, kinds)], lists],
            names=["n_tokens", "n_known", "base_score", "score", "rare"],
        )

    return F.arrow_udf(scored, _SCORED)


def score(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    Learns from the rows not held out. A null text is empty and has one token,
    its end. Repeated rows count as often as they are there; a null id counts
    as the empty text and is learned from. ``score`` is log10 of the model's
    probability of the lower-cased text's subword ids and its end. Extra
    columns are not read; an empty table gives no rows, and with nothing to
    learn from all counts are 0. ``path`` names a file every executor has.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (id_remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    model = fit(rows.where(~F.col("held_out")), path, **options)
    share = spark.sparkContext.broadcast
    denominator = model.tokens + model.kinds + 1
    scorer = _scorer(path, share(model.vocabulary), share(model.weights), share(model.top), denominator, model.texts)
    scored = rows.select("doc_id", "held_out", scorer("body").alias("s")).select(
        "doc_id", "held_out", "s.*", F.monotonically_increasing_id().alias("row")
    )
    with long_rows(spark, TEXT_ROWS):
        scored = stored(scored, "scored")
    rare = scored.select("row", F.inline("rare")).join(model.words.withColumnRenamed("n", "c"), "word")
    # A word without count adds (0 + 1) / denominator; the join only corrects the others.
    extra = rare.groupBy("row").agg(F.sum("n").alias("_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("_more"))
    listed = F.aggregate("rare", F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    return scored.join(extra, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_more", F.lit(0.0)) - listed * float(np.log10(denominator))).alias("base_score"),
        "score",
    )
