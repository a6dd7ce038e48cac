"""Language identification by interpolated Kneser-Ney character models.

One model of order 4 per language. Character n-grams are packed into 64 bits,
spread by a bijection and kept in sorted arrays shared by all languages, next
to a matrix with one column per language: a lookup gives every language's log
probability at once. The language with the lowest cross-entropy per character
wins. The score is its share after a softmax whose sharpness is fitted on
pieces kept out of the counts; a text is rejected when its cross-entropy lies
above what those pieces show for texts of their language.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camlytics.llm.common import id_remainder, mix, packed, slices

ORDER = 4
PIECE = 500
#: Pieces of PIECE characters per language that the models are fitted on, about.
TRAIN_PIECES = 3000
#: One of so many sampled pieces is kept out of the counts for the calibration.
KEPT_OUT = 5
CHUNK = 1 << 20
UNKNOWN = "und"
FOLDS, HELD_OUT = 5, 0

_LETTER = np.zeros(1 << 16, dtype=bool)
_LETTER[[i for i in range(1 << 16) if chr(i).isalpha()]] = True
_MASK = [np.uint64((1 << (16 * n)) - 1) for n in range(ORDER + 1)]


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as 16-bit codes; a run of anything else is one space.

    Letters beyond 16 bits share one code. Three spaces stand in front.
    """
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    high = raw >= 0xFFFF
    if high.any():
        raw = raw.copy()
        letters = np.array([chr(c).isalpha() for c in raw[high].tolist()], dtype=bool)
        raw[high] = np.where(letters, 0xFFFF, 32)
        letter = _LETTER[raw] | (raw == 0xFFFF)
    else:
        letter = _LETTER[raw]
    codes = np.where(letter, raw, 32).astype(np.uint16)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1]
    codes = codes[keep]
    if len(codes) and codes[0] == 32:
        codes = codes[1:]
    if not len(codes):
        return codes
    end = [] if codes[-1] == 32 else [32]
    return np.concatenate([[32, 32, 32], codes, end]).astype(np.uint16)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Packed 4-grams that end at each position from the fourth on."""
    c = codes.astype(np.uint64)
    return c[:-3] << np.uint64(48) | c[1:-2] << np.uint64(32) | c[2:-1] << np.uint64(16) | c[3:]


class Table(NamedTuple):
    """Sorted spread keys with their rows, and where each prefix of the keys begins."""

    keys: np.ndarray
    rows: np.ndarray
    begins: np.ndarray
    shift: int
    longest: int

    def find(self, packed: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        wanted = mix(packed)
        at = self.begins[(wanted >> np.uint64(self.shift)).astype(np.int64)]
        found = np.full(len(wanted), -1, dtype=np.int64)
        open_ = np.arange(len(wanted))
        for _ in range(self.longest):
            here = np.minimum(at[open_], len(self.keys) - 1)
            held = self.keys[here]
            hit = held == wanted[open_]
            found[open_[hit]] = here[hit]
            open_ = open_[held < wanted[open_]]
            if not len(open_):
                break
            at[open_] += 1
            open_ = open_[at[open_] < len(self.keys)]
        return found


def _table(packed: np.ndarray, rows: np.ndarray) -> Table:
    keys = mix(packed)
    order = np.argsort(keys)
    keys = keys[order]
    bits = max(4, int(len(keys)).bit_length() + 2)
    shift = 64 - bits
    prefix = (keys >> np.uint64(shift)).astype(np.int64)
    begins = np.searchsorted(prefix, np.arange(1 << bits)).astype(np.int32)
    longest = int(np.bincount(prefix).max()) if len(keys) else 0
    return Table(keys, np.ascontiguousarray(rows[order], dtype=np.float32), begins, shift, longest + 1)


class Model(NamedTuple):
    languages: list[str]
    grams: list[Table]  # by order, from 1: log probability per language
    backoffs: list[Table]  # by order, from 2: log weight of the lower order after a context
    floor: np.ndarray  # log probability of a character never met
    sharpness: float
    limit: np.ndarray  # highest accepted cross-entropy per language, and its slope in 1 / sqrt(length)


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _kneser_ney(languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]):
    """Tables of the interpolated models from 4-gram counts."""
    by_order: list[dict] = [{} for _ in range(ORDER + 1)]
    for name in languages:
        keys, held = counts[name]
        by_order[ORDER][name] = (keys, held.astype(np.float64))
        for n in range(ORDER - 1, 0, -1):
            # Lower orders count the distinct characters seen to the left.
            keys, held = np.unique(keys & _MASK[n], return_counts=True)
            by_order[n][name] = (keys, held.astype(np.float64))
    voc = len(np.unique(np.concatenate([by_order[1][x][0] for x in languages]))) + 1
    grams, backoffs, lower, floor = [], [], None, np.zeros(len(languages))
    for n in range(1, ORDER + 1):
        union = np.unique(np.concatenate([by_order[n][x][0] for x in languages]))
        prob = np.zeros((len(union), len(languages)))
        contexts = np.unique(union >> np.uint64(16))
        weight = np.ones((len(contexts), len(languages)))
        for j, name in enumerate(languages):
            keys, held = by_order[n][name]
            d = _discount(held)
            place = np.searchsorted(contexts, keys >> np.uint64(16))
            total = np.bincount(place, weights=held, minlength=len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            seen = total > 0
            weight[seen, j] = d * kinds[seen] / total[seen]
            own = np.zeros(len(union))
            own[np.searchsorted(union, keys)] = (held - d) / total[place]
            prob[:, j] = own
        if n == 1:
            floor = weight[0] / voc
            prob += floor
        else:
            prob += weight[np.searchsorted(contexts, union >> np.uint64(16))] * lower[1][
                np.searchsorted(lower[0], union & _MASK[n - 1])
            ]
            backoffs.append(_table(contexts, np.log(weight)))
        grams.append(_table(union, np.log(prob)))
        lower = (union, prob)
    return grams, backoffs, np.log(floor)


def _scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed log probabilities (text, language) and scored characters per text."""
    sums, lengths = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), dtype=np.int64)
    codes: list[np.ndarray] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal codes, owner, held
        if not codes:
            return
        keys = np.concatenate([_grams(c) for c in codes])
        sizes = np.array([len(c) - 3 for c in codes])
        out = np.zeros((len(keys), len(model.languages)), dtype=np.float32)
        left = np.arange(len(keys))
        for n in range(ORDER, 0, -1):
            part = keys[left] & _MASK[n]
            at = model.grams[n - 1].find(part)
            hit = at >= 0
            out[left[hit]] += model.grams[n - 1].rows[at[hit]]
            left, part = left[~hit], part[~hit]
            if not len(left):
                break
            if n > 1:
                at = model.backoffs[n - 2].find(part >> np.uint64(16))
                hit = at >= 0
                out[left[hit]] += model.backoffs[n - 2].rows[at[hit]]
            else:
                out[left] += model.floor.astype(np.float32)
        total = np.add.reduceat(out, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0, dtype=np.float64)
        np.add.at(sums, owner, total)
        np.add.at(lengths, owner, sizes)
        codes, owner, held = [], [], 0

    for i, text in enumerate(texts):
        # A text longer than CHUNK is scored in chunks that each start anew.
        for at in range(0, len(text) if text else 0, CHUNK):
            part = _codes(text[at : at + CHUNK])
            if len(part) > 3:
                codes.append(part)
                owner.append(i)
                held += len(part)
                if held >= CHUNK // 4:
                    flush()
    flush()
    return sums, lengths


def _softmax(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-(entropy - entropy.min(axis=1, keepdims=True)) * sharpness)
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, train: Column | None = None, pieces: int = TRAIN_PIECES, seed: int = 0,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Models of every language among the rows with text and language (and ``train`` true).

    Fitted on about ``pieces`` pieces of PIECE characters per language, picked
    from all places of all texts by a hash of id and place. None without rows.
    The sample bounds the model, whatever the table's size.
    """
    known = F.col(text).isNotNull() & F.col(lang).isNotNull()
    labelled = docs.where(known if train is None else known & train).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(seed), F.col(doc_id)).alias("at")
    )
    totals = labelled.groupBy("lang").agg(F.sum(F.ceil(F.length("text") / PIECE)).alias("n")).collect()
    chance = {r["lang"]: min(1.0, pieces / max(1, r["n"])) for r in totals}
    if not chance:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            kept: list[tuple[str, str]] = []
            langs, at = batch.column(0).to_pylist(), batch.column(2).to_numpy().astype(np.uint64)
            for i, name in enumerate(langs):
                body = batch.column(1)[i].as_py()
                number = -(-len(body) // PIECE)
                draw = mix(at[i] + np.arange(1, number + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                for k in np.flatnonzero((draw >> np.uint64(11)) * 2.0**-53 < chance[name]).tolist():
                    piece = body[k * PIECE : (k + 1) * PIECE]
                    if int(draw[k]) % KEPT_OUT == 0:
                        kept.append((name, piece))
                        continue
                    codes = _codes(piece)
                    if len(codes) > 3:
                        found.setdefault(name, []).append(_grams(codes))
            rows = [(name, *np.unique(np.concatenate(g), return_counts=True)) for name, g in found.items()]
            yield pa.record_batch({
                "lang": pa.array([n for n, k, _ in rows for _ in range(len(k))] + [n for n, _ in kept], pa.string()),
                "gram": pa.array(np.concatenate([k for _, k, _ in rows] + [np.zeros(len(kept), np.uint64)]).astype(np.int64)),
                "n": pa.array(np.concatenate([c for _, _, c in rows] + [np.zeros(len(kept), np.int64)]).astype(np.int64)),
                "piece": pa.array([None] * sum(len(k) for _, k, _ in rows) + [p for _, p in kept], pa.string()),
            })

    sampled = labelled.mapInArrow(count, "lang string, gram long, n long, piece string")
    # Bounded by the sample: counts of about ``pieces`` pieces and the kept pieces of each language.
    got = sampled.groupBy("lang", "gram", "piece").agg(F.sum("n").alias("n")).toArrow()
    counted, kept = got.filter(pc.is_null(got["piece"])), got.filter(pc.is_valid(got["piece"])).sort_by([("lang", "ascending"), ("piece", "ascending")])
    languages = sorted(pc.unique(counted["lang"]).to_pylist())
    if not languages:
        return None
    counts = {}
    for name in languages:
        rows = counted.filter(pc.equal(counted["lang"], name))
        grams = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(grams)
        counts[name] = (grams[order], rows["n"].to_numpy()[order])
    return _calibrated(Model(languages, *_kneser_ney(languages, counts), 1.0, np.zeros((len(languages), 2))), kept)


def _calibrated(model: Model, kept: pa.Table) -> Model:
    kept = kept.filter(pc.is_in(kept["lang"], pa.array(model.languages)))
    sums, lengths = _scores(model, kept["piece"].to_pylist())
    ok = lengths > 0
    if ok.sum() < 10:
        return model._replace(sharpness=10.0, limit=np.tile([np.inf, 0.0], (len(model.languages), 1)))
    entropy = -sums[ok] / lengths[ok][:, None]
    truth = np.searchsorted(model.languages, np.array(kept["lang"].to_pylist(), dtype=str)[ok])
    grid = 2.0 ** np.arange(-1, 8)
    fitted = [np.log(np.maximum(_softmax(entropy, s)[np.arange(len(truth)), truth], 1e-9)).mean() for s in grid]
    limit = np.empty((len(model.languages), 2))
    for j in range(len(model.languages)):
        own = entropy[truth == j, j]
        own = own if len(own) >= 5 else entropy[np.arange(len(truth)), truth]
        # Far outside the labelled pieces: twelve times the spread above their middle, more for short texts.
        middle, spread = np.median(own), max(np.percentile(own, 95) - np.median(own), 0.02)
        limit[j] = middle + 4 * spread, 8 * spread * np.sqrt(PIECE)
    return model._replace(sharpness=float(grid[int(np.argmax(fitted))]), limit=limit)


def _predict(model: Model, texts: pa.Array) -> pa.StructArray:
    parts = [_scores(model, part.to_pylist()) for part in slices(texts)]
    sums = np.concatenate([p[0] for p in parts] or [np.zeros((0, len(model.languages)))])
    lengths = np.concatenate([p[1] for p in parts] or [np.zeros(0, dtype=np.int64)])
    known = lengths > 0
    entropy = -sums / np.maximum(lengths, 1)[:, None]
    best = entropy.argmin(axis=1)
    score = np.where(known, _softmax(entropy, model.sharpness)[np.arange(len(best)), best], 0.0)
    limit = model.limit[best, 0] + model.limit[best, 1] / np.sqrt(np.maximum(lengths, 1))
    lowest = entropy[np.arange(len(best)), best]
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    return pa.StructArray.from_arrays(
        [
            pa.array(names[np.where(known, best, len(model.languages))], pa.string()),
            pa.array(score, pa.float64()),
            pa.array(np.where(known, lowest, np.nan), pa.float64(), from_pandas=True),
            pa.array(known & (lowest <= limit)),
        ],
        names=["lang", "score", "entropy", "accepted"],
    )


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    """struct(lang, score, entropy, accepted) of each text.

    A null text or one without a letter is ``und`` with score 0 and is not
    accepted; so is every text when there is no model. Ties go to the first
    language by name. ``entropy`` is in nats per character.
    """
    kind = "struct<lang: string, score: double, entropy: double, accepted: boolean>"
    if model is None:
        return F.struct(
            F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("accepted"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the training sample allows

    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        return _predict(shared.value, texts)

    return predict(F.col(text))


def training(doc_id: str = "doc_id") -> Column:
    """Rows the models may learn from."""
    return id_remainder(doc_id, FOLDS) != HELD_OUT


def language_of(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, accepted for each row, learned from the rows not held out.

    Extra columns are not read; repeated rows and null ids are kept (a null id
    counts as the empty text, which is held out).
    """
    model = fit(docs, train=training(), **options)
    found = docs.select("doc_id", (id_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), identify(docs, model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.entropy", "found.accepted")


def accepted(docs: DataFrame, **options) -> DataFrame:
    """The rows whose text one of the learned languages accepts, with the columns they came with."""
    model = fit(docs, train=training(), **options)
    whole = docs.select(packed(docs).alias("row"), identify(docs, model).alias("found"))
    return whole.where("found.accepted").select("row.*")
