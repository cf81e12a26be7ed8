"""Language identification by family first, then by one-versus-one linear SVMs within the family.

A text becomes a vector of hashed letter n-grams (bytes, one to three long; all that isn't a letter is a blank), taken
over the whole text. A linear SVM for every two families votes for the family, and one for every two languages of
the winner votes for the language.

The SVMs learn from a sample of the labelled rows, whose bound is a parameter; everything else is over all rows. Each
duel is fitted in a task of its own or with a few others, from the sample as a broadcast; sample and fitted duels are
held against MODEL_BYTES first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, small, stored
from .shingles import mix, text_slices

SIZE = 1 << 11
#: Rows to learn from, of all languages together and of one; about so many of each language however many there are.
SAMPLE_ROWS, LANGUAGE_ROWS, LEAST_ROWS = 8_000, 1_200, 20
SLICE_ROWS = 400
EPOCHS, PENALTY = 12, 4.0
#: Bytes of a broadcast sample or model at most; more of them is an error.
MODEL_BYTES = 128 << 20
#: Codes without a family up to which each is a family of its own; beyond it those with a first letter in common are one.
OWN_FAMILIES = 32
UNKNOWN = "und"

# Families of language codes.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa si ur",
    "turkic": "az kk ky tr tt uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
}

_letter = np.full(256, 32, np.uint8)
for _c in range(97, 123):
    _letter[_c] = _letter[_c - 32] = _c
_letter[128:] = np.arange(128, 256)


def family(lang: str) -> str | None:
    return next((k for k, v in FAMILIES.items() if lang.lower().replace("_", "-").split("-")[0] in v.split()), None)


def families(langs: list[str]) -> dict[str, str]:
    """The family of each language, those of FAMILIES or, for other codes, as OWN_FAMILIES says."""
    known = {lang: family(lang) for lang in langs}
    few = sum(v is None for v in known.values()) <= OWN_FAMILIES
    return {k: v or (f"own:{k}" if few else f"other:{k[:1].lower()}") for k, v in known.items()}


def vectors(column: pa.Array, size: int = SIZE) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix) of consecutive rows: square roots of n-gram counts, scaled to length 1."""
    for lo, hi, data, offsets in text_slices(column):
        code = _letter[data].astype(np.int64)
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
        keep[offsets[:-1][np.diff(offsets) > 0]] = True  # a text's first blank is no repeat of the last text's
        for a in range(0, hi - lo, SLICE_ROWS):
            b = min(hi - lo, a + SLICE_ROWS)
            part = slice(offsets[a], offsets[b])
            own = keep[part]
            x = code[part][own]
            row = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))[own]
            out = np.zeros((b - a) * size)
            gram = np.zeros(len(x), np.int64)
            for n in range(1, 4):
                gram = gram[: len(x) - n + 1] * 256 + x[n - 1 :] if len(x) >= n else gram[:0]
                inside = row[: len(gram)] == row[n - 1 :][: len(gram)]
                at = (mix(gram[inside].astype(np.uint64), 70 + n) & np.uint64(size - 1)).astype(np.int64)
                out += np.bincount(row[: len(gram)][inside] * size + at, minlength=len(out))
            m = np.sqrt(out.reshape(b - a, size))
            norm = np.sqrt((m * m).sum(1, keepdims=True))
            yield lo + a, (m / np.where(norm > 0, norm, 1)).astype(np.float32)


def has_letter(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(column, r"\p{L}").fill_null(False))


def svm(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, penalty: float = PENALTY) -> np.ndarray:
    """Weights (the bias last) of a linear SVM with squared hinge loss, by dual coordinate descent. y is 1 or -1."""
    share = np.array([0.5 / max(1, (y == s).sum()) for s in (-1, 1)])
    slack = 1 / (2 * penalty * len(x) * share[(y > 0).astype(int)])
    w, alpha, rng = np.zeros(x.shape[1] + 1), np.zeros(len(x)), np.random.default_rng(3)
    row = np.ones(len(w))
    square = np.einsum("ij,ij->i", x, x, dtype=np.float64) + 1 + slack
    for _ in range(epochs):
        for k in rng.permutation(len(x)):
            row[:-1] = x[k]
            new = max(0.0, alpha[k] - (y[k] * (row @ w) - 1 + slack[k] * alpha[k]) / square[k])
            if new != alpha[k]:
                w += (new - alpha[k]) * y[k] * row
                alpha[k] = new
    return w.astype(np.float32)


def duels(langs: list[str]) -> list[tuple[str | None, str, str]]:
    """(family, language, language) of every two languages of a family, and (None, family, family)."""
    of = families(langs)
    groups = {f: sorted(k for k in of if of[k] == f) for f in sorted(set(of.values()))}
    return [*((None, a, b) for a, b in combinations(groups, 2)), *((f, a, b) for f, v in groups.items() for a, b in combinations(v, 2))]


def duel_weights(x: np.ndarray, langs: np.ndarray, duel: tuple[str | None, str, str]) -> np.ndarray:
    """Of one duel, from all the sample's rows (16-bit floats), of which it takes those of its two sides."""
    within, a, b = duel
    of = families(sorted(set(langs)))
    side = langs if within is not None else np.array([of[v] for v in langs], object)
    keep = np.flatnonzero((side == a) | (side == b))
    return svm(x[keep].astype(np.float32), np.where(side[keep] == b, 1.0, -1.0))


def _fitted(sample, plan: list[tuple[str | None, str, str]]):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, names = sample.value
            x, langs = np.frombuffer(raw, np.float16).reshape(len(names), SIZE), np.array(names, object)
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([duel_weights(x, langs, plan[k]).tobytes()], pa.binary())], names=["duel", "w"])

    return run


def _fit_size(plan: list[tuple[str | None, str, str]]) -> int:
    return len(plan) * 4 * (SIZE + 1)


def fit(sample: DataFrame) -> dict | None:
    """Duels of families, and of the languages in each, from sample(lang, v). None without rows."""
    spark = sample.sparkSession
    size, found = sample.count(), sorted(r[0] for r in sample.select("lang").distinct().toLocalIterator())
    plan = duels(found)
    if max(2 * SIZE * size, _fit_size(plan)) > MODEL_BYTES:
        raise ValueError(f"{len(found)} languages make {len(plan)} duels and a sample of {size} rows, more than MODEL_BYTES: clean the labels or raise it")
    if not found:
        return None
    rows = sorted((tuple(r) for r in sample.toLocalIterator()), key=lambda r: (r[0], bytes(r[1])))
    model: dict = {"groups": {}, "families": {}, "within": {}}
    for lang, name in families(found).items():
        model["groups"].setdefault(name, []).append(lang)
        model["within"].setdefault(name, {})
    if plan:
        shared = spark.sparkContext.broadcast((b"".join(bytes(r[1]) for r in rows), [r[0] for r in rows]))
        fitted = spark.range(0, len(plan), 1, min(len(plan), 400)).mapInArrow(_fitted(shared, plan), "duel long, w binary")
        for k, w in sorted((r[0], bytes(r[1])) for r in stored(fitted, "duels").toLocalIterator()):
            name, a, b = plan[k]
            (model["families"] if name is None else model["within"][name])[a, b] = np.frombuffer(w, np.float32)
    return model


def _votes(x: np.ndarray, names: list[str], duels: dict) -> tuple[np.ndarray, np.ndarray]:
    """(winner's place in names, certainty): most duels won, then the greatest sum of margins."""
    won, margin, sure = (np.zeros((len(x), len(names))) for _ in range(3))
    sure += 1
    for (a, b), w in duels.items():
        d = x @ w[:-1] + w[-1]
        i, j = names.index(a), names.index(b)
        p = 1 / (1 + np.exp(-2 * np.clip(d.astype(float), -20, 20)))
        won[:, i] += d <= 0
        won[:, j] += d > 0
        margin[:, i] -= d
        margin[:, j] += d
        sure[:, i] = np.minimum(sure[:, i], 1 - p)
        sure[:, j] = np.minimum(sure[:, j], p)
    best = np.argmax(won + np.tanh(margin / 100) / 4, axis=1)
    return best, sure[np.arange(len(x)), best]


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names = sorted(model["groups"])
    at, score = _votes(x, names, model["families"])
    lang = np.empty(len(x), object)
    for k, name in enumerate(names):
        rows = np.flatnonzero(at == k)
        if len(rows):
            best, sure = _votes(x[rows], model["groups"][name], model["within"][name])
            lang[rows] = np.array(model["groups"][name], object)[best]
            score[rows] *= sure
    return lang, score


@freed
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, m in vectors(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(m)), pa.array([v.astype(np.float16).tobytes() for v in m], pa.binary())], names=["lang", "v"])


def _predicted(model):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            lang, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            if fitted:
                for lo, m in vectors(batch.column(1)):
                    lang[lo : lo + len(m)], score[lo : lo + len(m)] = predict(fitted, m)
                none = ~has_letter(batch.column(1))
                lang[none], score[none] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(doc_id, folds: int = 5):
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, language_rows: int = LANGUAGE_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row for each of docs(doc_id, text, lang).

    Rows that aren't held out and have a lang, and a letter in their text, may be learned from: of each
    language about `language_rows` or fewer, `sample_rows` together, chosen by a hash of the doc_id; where there are
    many languages, each one still has about LEAST_ROWS, or all that it has. Duels grow with the square of the
    languages of a family, and of the families; where they or the sample pass MODEL_BYTES, that is an error. A
    text that is null or has no letter is `und` with score 0; without anything to learn from, each one is. A null
    doc_id counts as the empty text. Ties of votes go by margins. Equal texts get equal answers.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang", held_out(F.col("doc_id")).alias("held_out"))
    usable = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = stored(usable.groupBy(F.col("lang").alias("_lang")).count(), "languages")
    model = None
    if many := counts.count():
        each = max(LEAST_ROWS, min(language_rows, sample_rows // many))
        shares = counts.select("_lang", (F.least(F.lit(1.0), F.lit(each) / F.col("count")) * 2**30).cast("long").alias("_share"))
        chosen = usable.join(small(shares, many), F.col("lang") == F.col("_lang")).where(F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) < F.col("_share"))
        model = fit(stored(chosen.select("lang", "text").mapInArrow(_features, "lang string, v binary"), "sample"))
    shared = spark.sparkContext.broadcast(model)
    return rows.select("doc_id", "text", "held_out").mapInArrow(_predicted(shared), "doc_id long, held_out boolean, lang_pred string, score double")
