"""Language ID by string kernels.

Two texts are as alike as the character n-grams (one to four characters, presence only) they
share: k(x, y) = |X & Y| / sqrt(|X| |Y|), with X and Y taken within the n-grams of the landmarks.
Landmarks are texts of the training sample; the Nystroem map K(., L) K(L, L)^(-1/2) makes vectors
of kernel rows, and one ridge regression per language separates it from the rest. Scoring is a
product of matrices per batch of texts: presence x (landmarks x weights).

Only the fit sees a bounded sample: about ``sample`` labelled texts per language, landmarks among
them. Every text is scored, and whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cartwheel.llm.common import free_names, map_batches

SAMPLE = 300          # training texts per language
LANDMARKS = 40        # of these, per language
ALL_SAMPLE = 2400     # training texts and landmarks of all languages together: with very many
ALL_LANDMARKS = 400   # languages each of them gets fewer, but one text at least
SAMPLE_CHARS = 20_000  # of a longer text the sample takes a window
ALL_CHARS = 48 << 20  # of all these texts together: with very many languages windows are shorter
RIDGE = 1e-2
SHARPNESS = 8.0       # of the score as a function of the margin
SIZES = (1, 2, 3, 4)
UNKNOWN = "und"

_BITS = 20            # n-grams are told apart by so many bits of their hash
_CHUNK = 1 << 18      # characters worked on at once
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    places: np.ndarray      # for each hash: row of ``weights``, or -1
    weights: np.ndarray     # n-grams of the landmarks x languages, or x landmarks if these are fewer
    marks: np.ndarray | None    # landmarks x languages, then
    bias: np.ndarray


def _grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of the lower-cased text, chunk by chunk; chunks overlap."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    for start in range(0, len(codes), _CHUNK):
        part = codes[start:start + _CHUNK + max(SIZES) - 1]
        rolled = np.zeros(len(part), np.uint64)
        for n in SIZES:
            if len(part) < n:
                break
            rolled = (rolled[:len(part) - n + 1] if n > 1 else rolled) * np.uint64(0x9E3779B97F4A7C15)
            rolled = rolled + part[n - 1:] * np.uint64(0xC2B2AE3D27D4EB4F)
            rolled = rolled ^ (rolled >> np.uint64(29))
            yield (rolled * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _BITS)).astype(np.int64)


def _present(text: str) -> np.ndarray:
    found = np.zeros(1 << _BITS, bool)
    for grams in _grams(text):
        found[grams] = True
    return np.flatnonzero(found)


def training_rows(docs: DataFrame) -> Column:
    """Documents whose crc32(doc_id as text) mod 4 is not 2."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2


def _window(text: Column, draw: Column, chars: int) -> Column:
    """A text of the sample: whole, or some ``chars`` of a longer one with a letter in them."""
    some = F.substring(text, (F.pmod(draw, F.length(text) - chars + 1) + 1).cast("int"), F.lit(chars))
    lettered = F.regexp_substr(text, F.lit(rf"\p{{L}}[\s\S]{{0,{chars - 1}}}"))
    return F.when(F.length(text) <= chars, text).otherwise(
        F.when(F.rlike(some, F.lit(r"\p{L}")), some).otherwise(lettered))


def _once(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a label once in a task, told apart by its hashes."""
    seen: set[tuple] = set()
    for batch in rows:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "draw", "other"))))
        new = []
        for i, key in enumerate(keys):
            if key not in seen:
                seen.add(key)
                new.append(i)
        if new:
            yield batch.take(pa.array(new))


def fit(labelled: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, text: str = "text",
        lang: str = "lang") -> Model | None:
    """Learn from rows with a text with letters and a label; None if there are none.

    The distinct texts of each label are counted; then each label keeps the ``sample`` of them with
    the smallest hashes, however often each is repeated. Every label is learned. The driver sees
    about ``ALL_SAMPLE`` texts of bounded length, or one of each label if there are more of these.
    """
    usable = (labelled.filter(F.col(lang).isNotNull() & F.rlike(text, F.lit(r"\p{L}")))
              .select(F.col(lang).alias("lang"), F.xxhash64(text, F.lit(11)).alias("draw"),
                      F.xxhash64(F.lit(5), text).alias("other"), F.col(text).alias("text")))
    counts = (usable.groupBy("lang", "draw", "other").agg(F.lit(1)).groupBy("lang").count()
              .orderBy(F.desc("count"), "lang").collect())
    if not counts:
        return None
    sample = max(1, min(sample, ALL_SAMPLE // len(counts)))
    landmarks = min(landmarks, ALL_LANDMARKS // len(counts))
    chars = max(100, min(SAMPLE_CHARS, ALL_CHARS // (sample * len(counts))))
    picked, missing, wide = [], {r["lang"]: r["count"] for r in counts}, 1.3 * sample + 50
    while missing:   # the smallest hashes lie below a bar; if too few do, look further up
        bar = F.create_map(*[F.lit(x) for name, n in missing.items()
                             for x in (name, min(1.0, wide / n) * 2.0 ** 64 - 2.0 ** 63)])
        drawn = usable.filter(F.col("draw") <= F.element_at(bar, F.col("lang")))
        drawn = drawn.withColumn("text", _window(F.col("text"), F.col("other"), chars))
        once = map_batches(drawn, _once, drawn.schema).dropDuplicates(["lang", "draw", "other"])
        order = Window.partitionBy("lang").orderBy("draw", "other")
        rows = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample).collect()
        found = Counter(r["lang"] for r in rows)
        done = {name for name, n in missing.items() if found[name] >= min(sample, n) or wide >= n}
        picked += [r for r in rows if r["lang"] in done]
        missing, wide = {name: n for name, n in missing.items() if name not in done}, 4 * wide
    by_lang: dict[str, list[str]] = {}
    for row in sorted(picked, key=lambda r: (r["lang"], r["rank"])):
        by_lang.setdefault(row["lang"], []).append(row["text"])
    names = tuple(sorted(by_lang))
    grams = {n: [_present(t) for t in by_lang[n]] for n in names}
    # with more languages than landmarks, those of some languages, evenly dealt, serve them all
    lent = names if landmarks else [names[i * len(names) // ALL_LANDMARKS] for i in range(ALL_LANDMARKS)]
    marks = [g for n in lent for g in grams[n][:max(landmarks, 1)]]
    vocabulary = np.unique(np.concatenate(marks))
    places = np.full(1 << _BITS, -1, np.int32)
    places[vocabulary] = np.arange(len(vocabulary))

    def presence(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), len(vocabulary)), np.float32)
        for i, g in enumerate(rows):
            at = places[g]
            out[i, at[at >= 0]] = 1
        return out / np.sqrt(np.maximum(out.sum(1, keepdims=True), 1))

    marked = presence(marks)
    values, vectors = np.linalg.eigh((marked @ marked.T).astype(float))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])          # K(L, L)^(-1/2)
    features, target = [], []
    for i, n in enumerate(names):
        features.append((presence(grams[n]) @ marked.T) @ root)
        target.append(np.where(np.arange(len(names)) == i, 1.0, -1.0) * np.ones((len(grams[n]), 1)))
    x, y = np.concatenate(features), np.concatenate(target)
    weigh = np.concatenate([np.full((len(f), 1), 1 / len(f)) for f in features])   # languages alike
    mean = (weigh * y).sum(0) / weigh.sum()
    gram = x.T @ (weigh * x) + RIDGE / x.shape[1] * np.eye(x.shape[1])
    ridge = np.linalg.solve(gram, x.T @ (weigh * (y - mean)))
    of_marks = (root @ ridge).astype(np.float32)
    if len(marks) < len(names):
        return Model(names, places, np.ascontiguousarray(marked.T), of_marks, mean)
    return Model(names, places, (marked.T @ of_marks).astype(np.float32), None, mean)


def _scores(model: Model, texts: list[str]) -> np.ndarray:
    """Scores of a batch: one row of presence per text, one product for all languages."""
    norms = np.ones(len(texts))
    presence = np.zeros((len(texts), len(model.weights)), np.float32)
    for i, text in enumerate(texts):
        for grams in _grams(text):
            at = model.places[grams]
            presence[i, at[at >= 0]] = 1
        norms[i] = max(1.0, presence[i].sum())
    found = presence @ model.weights
    return (found if model.marks is None else found @ model.marks) / np.sqrt(norms)[:, None] + model.bias


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to every row.

    ``und`` with score 0 stands for a null text, one without a letter, or a missing model. Nothing
    but the text is looked at. Repeated rows get the same answer, an empty table gives an empty
    result, and columns with these names get ``_in`` appended.
    """
    docs = free_names(docs, "lang_pred", "score")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)   # bounded by languages x landmarks

    def predict(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in rows:
            texts = batch.column(text).to_pylist()
            names, values = [UNKNOWN] * len(texts), [0.0] * len(texts)
            some = [i for i, t in enumerate(texts) if t and own and _LETTER.search(t)]
            for start in range(0, len(some), 64):
                part = some[start:start + 64]
                scores = _scores(own, [texts[i] for i in part])
                sharp = np.exp(SHARPNESS * (scores - scores.max(1, keepdims=True)))
                for i, best, value in zip(part, scores.argmax(1), 1 / sharp.sum(1)):
                    names[i], values[i] = own.languages[best], float(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(values, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    return map_batches(docs, predict, schema)


def language_digest(docs: DataFrame) -> DataFrame:
    """Train on three quarters of the documents by their id, predict all."""
    model = fit(docs.filter(training_rows(docs)))
    held_out = F.coalesce(~training_rows(docs), F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")
