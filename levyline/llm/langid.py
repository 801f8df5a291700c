"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound as the product of its letters' vectors, each rotated by
its place. The trigrams of a text are bundled by adding them up, those of a language's training texts
likewise, and a text gets the language whose bundle has the largest cosine with its own. Letters are Unicode letters in
lower case; whatever stands between words is one space.

Bundles are sums of whole numbers, so a model does not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.llm.textsets import map_rows, mix, small_batches
from levyline.session import written

DIMS = 1024
SAMPLE = 1500  # documented bound: labelled rows per language that the profiles are made of
LANGUAGES = 1024  # documented bound: the languages with the most labelled rows are learned
PIECE = 1_000_000  # characters of a text looked at together
BATCH = 400_000  # characters bundled together
GRAMS = 1024  # trigrams whose vectors are in memory at once
QUANTILE = 0.01  # of a language's labelled scores, from which its bound is made
CLASSES = 12  # texts count as alike long from 2**12 different trigrams on
HEADS = (8, 32, 128, 512, 2048)  # codes of the parts of labelled texts that stand for short texts
BINS = 400  # of a score from 0 to 1, when scores are counted
UNKNOWN = "und"
_SEED = 20


def _letter_table() -> np.ndarray:
    """For every code point itself in lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


_tables: dict[str, np.ndarray] = {}


def code_pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of the letters with one 0 before, after and between words, in parts that overlap by two."""
    if "letters" not in _tables:
        _tables["letters"] = _letter_table()
    tail = np.zeros(1, np.uint32)
    for start in range(0, len(text), PIECE):
        codes = _tables["letters"][np.frombuffer(text[start:start + PIECE].encode("utf-32-le", "replace"), np.uint32)]
        kept = codes > 0
        kept[1:] |= codes[:-1] > 0  # the first of each run of others stays
        kept[0] |= tail[-1] > 0
        tail = np.concatenate([tail[-2:], codes[kept]])
        yield tail
    if tail[-1]:
        yield np.append(tail[-2:], np.uint32(0))


def distinct_trigrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of consecutive codes as rows of three code points, and the number of each place's trigram.

    Letters are numbered first, so that a table over all possible trigrams finds the distinct ones; where so
    many letters occur that the table would be large, they are found by sorting.
    """
    letters = np.flatnonzero(np.bincount(codes))
    k = len(letters)
    number = np.zeros(int(letters[-1]) + 1, np.int64)
    number[letters] = np.arange(k)
    n = number[codes]
    grams = (n[:-2] * k + n[1:-1]) * k + n[2:]
    if k**3 <= 2**22:
        names = np.flatnonzero(np.bincount(grams, minlength=k**3))
        table = np.zeros(k**3, np.int32)
        table[names] = np.arange(len(names))
        at = table[grams]
    else:
        names, at = np.unique(grams, return_inverse=True)
    return letters[np.stack([names // (k * k), names // k % k, names % k], axis=1)], at


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """The random vectors of code points, the same in every process: signs are bits of mixed counters."""
    words = mix(codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(DIMS // 64, dtype=np.uint64) + np.uint64(_SEED))
    bits = np.unpackbits(words.view(np.uint8).reshape(len(codes), -1), axis=1)
    return (bits.astype(np.float32) * 2 - 1)


def bound_vectors(grams: np.ndarray) -> np.ndarray:
    """The vectors of trigrams, rows of three code points."""
    letters = np.unique(grams)
    vectors, at = letter_vectors(letters), np.searchsorted(letters, grams)
    out = np.roll(vectors, 2, axis=1)[at[:, 0]]
    out *= np.roll(vectors, 1, axis=1)[at[:, 1]]
    out *= vectors[at[:, 2]]
    return out


def bundles(texts: list[str | None]) -> np.ndarray:
    """The bundled vector of every text, a row each; a text without letters is all zero."""
    return counted_bundles(len(texts), ((i, piece) for i, text in enumerate(texts) for piece in code_pieces(text or "")))[0]


def counted_bundles(n: int, parts: Iterable[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vectors of n texts and their numbers of trigrams; parts are (text, codes) in order of the texts."""
    out, totals = np.zeros((n, DIMS), np.float32), np.zeros(n)
    owners, pieces, held = [], [], 0

    def add() -> None:
        nonlocal held
        if held:
            grams, at = distinct_trigrams(np.concatenate(pieces))
            ends = np.cumsum([len(p) for p in pieces])
            whole = np.ones(len(at), bool)  # not across two pieces
            whole[ends[:-1] - 2] = whole[ends[:-1] - 1] = False
            first = owners[0]
            owner = np.repeat(np.array(owners) - first, [len(p) for p in pieces])[:-2]
            counts = np.bincount(owner[whole] * len(grams) + at[whole], minlength=(owners[-1] - first + 1) * len(grams)).reshape(-1, len(grams))
            for some in range(0, len(grams), GRAMS):
                out[first:owners[-1] + 1] += counts[:, some:some + GRAMS].astype(np.float32) @ bound_vectors(grams[some:some + GRAMS])
            totals[first:owners[-1] + 1] += counts.sum(axis=1)
        owners.clear()
        pieces.clear()
        held = 0

    for i, piece in parts:
        if len(piece) > 2:
            owners.append(i)
            pieces.append(piece)
            held += len(piece)
        if held >= BATCH:
            add()
    add()
    return out, totals


def length_class(vectors: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """0 .. CLASSES: the binary logarithm of how many different trigrams a text is worth; a repeated line counts once.

    The squared length of a bundle is about DIMS times the sum of the squared counts.
    """
    squares = np.maximum((vectors.astype(np.float64) ** 2).sum(axis=1) / DIMS, 1e-9)
    return np.clip(np.log2(np.maximum(totals * totals / squares, 1)).astype(np.int64), 0, CLASSES)


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # unit length, a row per language
    sums: np.ndarray  # the same before they were brought to unit length
    rows: np.ndarray  # labelled rows of each language


def fit(labelled: DataFrame, sample: int = SAMPLE, label: str = "profiles") -> Profiles:
    """Profiles from rows (id, text, lang): of each language the `sample` rows with the lowest hash of their id.

    Null languages and null texts are left out. Ties of a hash go by id. At most LANGUAGES languages are learned, those with the most
    rows (ties by name), so the profiles have a bounded size.
    """
    small_batches(labelled)
    known = labelled.select("id", "lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = dict(tuple(r) for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect())
    common = list(counts)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = known.select("id", "lang").filter(F.col("lang").isin(common)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample)
    ids = written(ids.select("id", "lang"), f"{label}-sample")
    # bounded: LANGUAGES * SAMPLE ids
    rows = known.join(F.broadcast(ids.dropDuplicates(["id", "lang"])), ["id", "lang"]).select("lang", "text")

    def add_up(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, vector in zip(names, bundles(batch.column(1).to_pylist()), strict=True):
                if at not in sums:
                    sums[at] = np.zeros(DIMS)
                sums[at] += vector
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "vector"])

    parts = rows.mapInArrow(add_up, "lang string, vector array<long>").select("lang", F.posexplode("vector").alias("place", "value"))
    whole = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).select("lang", "v.value").orderBy("lang").collect()
    found = [(r[0], np.array(r[1], np.float64)) for r in whole]
    found = [(name, v) for name, v in found if v.any()]
    sums = np.array([v for _, v in found], np.float64).reshape(-1, DIMS)
    unit = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return Profiles([name for name, _ in found], unit.astype(np.float32), sums, np.array([counts[name] for name, _ in found], np.int64))


def bounds(labelled: DataFrame, profiles: Profiles, sample: int = SAMPLE, quantile: float = QUANTILE) -> np.ndarray:
    """The least score of a text of each language (a row) and length class (a column) for it to count as that language.

    Every labelled row (id, text, lang) is scored against its own language, whole and by its first HEADS codes, as short
    texts score lower. The bound lies as far below the `quantile` of these scores as that lies below their median, and
    lower still by a share of 1 / sqrt(scores), as few rows say little, but not below the bound of shorter texts. Rows that are more like another language
    (wrong labels) do not count. Where all rows of a language are in its profile, a row is scored against the others. A class
    without scores has the bound of the next shorter one, at first 0: what no row tells about is kept. A language
    without any score has the least bounds of the others.
    """
    n_lang = len(profiles.languages)
    if not n_lang:
        return np.zeros((0, CLASSES + 1))
    place, whole = {name: i for i, name in enumerate(profiles.languages)}, profiles.rows <= sample
    small_batches(labelled)
    known = labelled.select("id", "lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")

    def score(batches):
        total = np.zeros((n_lang, CLASSES + 1, BINS), np.int64)
        for batch in batches:
            langs, ids, texts = (batch.column(i).to_pylist() for i in (1, 0, 2))
            rows = [(place[x], i is not None, t) for i, x, t in zip(ids, langs, texts, strict=True) if x in place]
            for first in range(0, len(rows), 256):
                some = rows[first:first + 256]
                lang = np.array([r[0] for r in some])
                full, n_full = counted_bundles(len(some), ((i, p) for i, r in enumerate(some) for p in code_pieces(r[2])))
                cosines = full @ profiles.vectors.T
                right = (n_full > 0) & (cosines.argmax(axis=1) == lang)
                own = profiles.sums[lang] - np.where((whole[lang] & np.array([r[1] for r in some]))[:, None], full, 0)
                far = np.linalg.norm(own, axis=1)
                right &= far > 0
                heads = [next(code_pieces(r[2]), ()) for r in some]
                row, vectors, totals = [np.flatnonzero(right)], [full[right]], [n_full[right]]
                for n in HEADS:  # each by itself, so that the product for the short ones is small
                    longer = np.array([i for i, h in enumerate(heads) if right[i] and n < len(h)], np.int64)
                    part, n_part = counted_bundles(len(longer), ((j, heads[i][:n]) for j, i in enumerate(longer)))
                    row, vectors, totals = [*row, longer], [*vectors, part], [*totals, n_part]
                row, vectors, totals = map(np.concatenate, (row, vectors, totals))
                lengths = np.linalg.norm(vectors, axis=1)
                row, vectors, totals, lengths = (x[lengths > 0] for x in (row, vectors, totals, lengths))
                cosine = (vectors * own[row]).sum(axis=1) / (lengths * far[row])
                bins = (np.clip(cosine, 0, 1 - 1e-9) * BINS).astype(np.int64)
                np.add.at(total, (lang[row], length_class(vectors, totals), bins), 1)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*at, total[at])], names=["lang", "class", "bin", "n"])

    counted = known.mapInArrow(score, "lang long, class long, bin long, n long").groupBy("lang", "class", "bin").agg(F.sum("n"))
    total = np.zeros((n_lang, CLASSES + 1, BINS), np.int64)
    for lang, klass, at, n in counted.collect():  # at most LANGUAGES * CLASSES * BINS numbers
        total[lang, klass, at] = n
    out, known_bounds = np.zeros((n_lang, CLASSES + 1)), total.any(axis=(1, 2))
    for i in np.flatnonzero(known_bounds):
        for k in range(CLASSES + 1):
            seen = total[i, k].cumsum()
            if not seen[-1]:
                out[i, k] = out[i, k - 1] if k else 0
                continue
            low, middle = (int(np.searchsorted(seen, max(1, share * seen[-1]))) / BINS for share in (quantile, 0.5))
            out[i, k] = max(0.0, (2 * low - middle) * (1 - seen[-1] ** -0.5))
    if known_bounds.any():
        out[~known_bounds] = out[known_bounds].min(axis=0)
    # what a class reaches longer texts reach, too; a class spans a factor of two, and its scores may come from the upper end,
    # so a text has the bound of the class below
    return np.concatenate([np.zeros((n_lang, 1)), np.maximum.accumulate(out, axis=1)[:, :-1]], axis=1)


def judge(column: pa.Array, profiles: Profiles) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a column, 256 texts at a time."""
    names, scores = [], np.zeros(len(column))
    for first in range(0, len(column), 256):
        vectors = bundles(column.slice(first, 256).to_pylist())
        if not profiles.languages:
            names += [UNKNOWN] * len(vectors)
            continue
        lengths = np.linalg.norm(vectors, axis=1)
        some = lengths > 0
        cosines = vectors @ profiles.vectors.T
        best = cosines.argmax(axis=1)
        top = cosines[np.arange(len(best)), best] / np.where(some, lengths, 1)
        scores[first:first + 256] = np.where(some, np.clip(top, 0, 1), 0)
        names += [profiles.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
    return names, scores


def predict(texts: DataFrame, profiles: Profiles) -> DataFrame:
    """The columns of `texts` but text, with lang_pred and score, the cosine cut to 0..1.

    A text that is null or has no letter, or any text if nothing was learned, is `und` with score 0. Ties go to the first
    language by name.
    """
    small_batches(texts)
    kept = [c for c in texts.columns if c != "text"]
    rows = texts.select(*kept, "text")

    def run(batches):
        for batch in batches:
            names, scores = judge(batch.column(n_kept), profiles)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n_kept)), pa.array(names, pa.string()), pa.array(scores)], names=fields)

    n_kept, fields = len(kept), [*kept, "lang_pred", "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by a checksum of their id; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of `docs` (doc_id, text, lang; other columns are left out).

    The profiles are learned from the rows that are not held out and have a language. Repeated rows are judged alike.
    """
    mine = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    profiles = fit(mine.filter("NOT held_out").select(F.col("doc_id").alias("id"), "text", "lang"), sample)
    return predict(mine.select("doc_id", "held_out", "text"), profiles)


def accepted(docs: DataFrame, quantile: float = QUANTILE, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs`, with all their columns, that reach the bound of some language for a text of their length.

    `und` texts go, and so do texts that are like no language that was learned, unless they are too short to tell. The bounds are those of
    the labelled rows that are not held out. With nothing learned every row goes.
    """
    mine = docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang")
    profiles = fit(mine, sample)
    least = bounds(mine, profiles, sample, quantile)
    place = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            kept = np.zeros(len(batch), bool)
            for first in range(0, len(batch) if len(least) else 0, 256):
                texts = batch.column(place).slice(first, 256).to_pylist()
                vectors, totals = counted_bundles(len(texts), ((i, p) for i, t in enumerate(texts) for p in code_pieces(t or "")))
                lengths = np.linalg.norm(vectors, axis=1)
                scores = np.clip(vectors @ profiles.vectors.T / np.where(lengths > 0, lengths, 1)[:, None], 0, 1)
                kept[first:first + 256] = (lengths > 0) & (scores >= least[:, length_class(vectors, totals)].T).any(axis=1)
            yield batch.filter(pa.array(kept))

    return map_rows(docs, keep)
