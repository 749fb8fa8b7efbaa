"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed letter n-grams (lengths 1 to 3, lower case,
words marked by a space on either side), weighted by TF-IDF and normalised.
Document frequencies are counted over all training rows. The centroids come
from spherical k-means over a bounded sample of every language's rows. A text
gets the language of the centroid with the largest cosine; it is rejected where
that cosine is below the floor for its length, as learnt from the same sample.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, release_memory, sampled

UNKNOWN = "und"
BUCKETS = 4096
_SPACE = 32
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter; built once in a worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def letter_codes(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, with one space around every run; empty without letters."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = _letter_table()[raw]
    if not is_letter.any():
        return np.zeros(0, dtype=np.uint32)
    codes = np.full(len(raw) + 2, _SPACE, dtype=np.uint32)
    codes[1:-1][is_letter] = raw[is_letter]
    blank = codes == _SPACE
    keep = ~(blank[1:] & blank[:-1])
    return np.concatenate([codes[:1], codes[1:][keep]])


def gram_counts(codes: np.ndarray, buckets: int) -> np.ndarray:
    """How often each bucket's n-grams of length 1 to 3 occur."""
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + one[2:]
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    hashed = np.concatenate([one, two, three])
    return np.bincount(((hashed ^ (hashed >> np.uint32(16))) * np.uint32(0x7FEB352D)) >> shift, minlength=buckets)


@dataclass(frozen=True)
class Languages:
    """A fitted classifier: idf per bucket, one row per centroid, and cosine floors by length.

    ``floors[b]`` holds for texts of 2**b to 2**(b+1) - 1 letter codes.
    """

    names: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floors: np.ndarray = field(default_factory=lambda: np.zeros(32, dtype=np.float32))

    def predict(self, texts: "pd.Series") -> pd.DataFrame:
        """lang, cosine and rejected of every text."""
        lang = np.full(len(texts), UNKNOWN, dtype=object)
        score = np.zeros(len(texts))
        rejected = np.ones(len(texts), dtype=bool)
        for start in range(0, len(texts), 256):
            codes = [letter_codes(t) for t in texts.iloc[start:start + 256]]
            rows = np.array([start + i for i, c in enumerate(codes) if len(c)], dtype=int)
            codes = [c for c in codes if len(c)]
            if not codes or not self.names:
                rejected[rows] = False
                continue
            nearest = vectors(codes, self.idf) @ self.centroids.T
            best = nearest.argmax(axis=1)
            lang[rows] = [self.names[self.owner[b]] for b in best]
            score[rows] = np.clip(nearest[np.arange(len(rows)), best], 0.0, 1.0)
            rejected[rows] = score[rows] < self.floors[[len(c).bit_length() - 1 for c in codes]]
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})


def vectors(codes: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors with damped term frequencies, one row per text."""
    counts = np.stack([gram_counts(c, len(idf)) for c in codes]).astype(np.float32)
    weighted = np.log1p(counts) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def cluster(rows: np.ndarray, count: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means: unit centroids, at most ``count``, none of them empty."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(count, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = [rows[nearest == k].sum(axis=0) for k in np.unique(nearest)]
        centres = np.stack([s / max(float(np.linalg.norm(s)), 1e-12) for s in sums])
    return centres


def _bucket_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    release_memory()
    seen = np.zeros(BUCKETS, dtype=np.int64)
    rows = 0
    for batch in batches:
        for text in batch["text"]:
            codes = letter_codes(text)
            if len(codes):
                seen += gram_counts(codes, BUCKETS) > 0
                rows += 1
    yield pd.DataFrame({"bucket": np.arange(-1, BUCKETS), "docs": np.concatenate([[rows], seen])})


def _windows(codes: list[np.ndarray], most: int = 64) -> list[np.ndarray]:
    """Up to ``most`` pieces of each power-of-two length from every text, evenly spread."""
    pieces = []
    for c in codes:
        length = 16
        while length < len(c):
            starts = np.linspace(0, len(c) - length, min(most, max(1, len(c) // length))).astype(int)
            pieces += [c[s:s + length] for s in starts]
            length *= 2
        pieces.append(c)
    return pieces


def fit_languages(
    docs: DataFrame,
    *,
    centroids: int = 4,
    sample_rows: int = 600,
    low_quantile: float = 0.0005,
    margin: float = 0.6,
    seed: int = 7,
) -> Languages:
    """Learn from ``text`` and ``lang`` of ``docs``; rows without a lang or a letter teach nothing.

    Document frequencies cover every row. ``sample_rows`` bounds the rows of one
    language that the centroids and floors are fitted to. A floor is ``margin``
    times the ``low_quantile`` of the cosines that pieces of that length reach
    with the centroids of their own language. Without any training row every
    text stays unknown, and only those without letters are rejected.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    counts = (
        known.select("text").mapInPandas(_bucket_frequencies, "bucket int, docs long")
        .groupBy("bucket").agg(F.sum("docs").alias("docs")).toPandas().set_index("bucket")["docs"]
        .reindex(range(-1, BUCKETS), fill_value=0).to_numpy()
    )
    idf = np.log((1.0 + counts[0]) / (1.0 + counts[1:])).astype(np.float32) + np.float32(1.0)

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = rows["text"].sort_values(kind="stable")
        codes = [c for c in map(letter_codes, texts) if len(c)]
        centres = cluster(vectors(codes, idf), centroids, seed)
        reached: dict[int, list[np.ndarray]] = {}
        pieces = _windows(codes, most=4)
        for start in range(0, len(pieces), 256):
            part = pieces[start:start + 256]
            best = (vectors(part, idf) @ centres.T).max(axis=1)
            for piece, cosine in zip(part, best, strict=True):
                reached.setdefault(len(piece).bit_length() - 1, []).append(cosine)
        floors = np.zeros(32, dtype=np.float32)
        for band, cosines in reached.items():
            if band >= 4:
                floors[band] = margin * np.quantile(cosines, low_quantile)
        return pd.DataFrame({
            "lang": [key[0]] * len(centres),
            "centroid": [c.astype(np.float32).tobytes() for c in centres],
            "floors": [floors.tobytes()] * len(centres),
        })

    fitted = (
        sampled(known, sample_rows, by="lang")
        .groupBy("lang").applyInPandas(fit, "lang string, centroid binary, floors binary")
        .toPandas().sort_values(["lang", "centroid"], ignore_index=True)
    )
    names = sorted(set(fitted["lang"]))
    if not names:
        return Languages([], idf, np.zeros((0, BUCKETS), np.float32), np.zeros(0, int))
    floors = np.stack([np.frombuffer(f, dtype=np.float32) for f in fitted["floors"]])
    # A length that some language never reached takes the floor of the next shorter one.
    lowest = np.where(floors > 0, floors, np.inf).min(axis=0)
    for band in range(1, 32):
        if not np.isfinite(lowest[band]):
            lowest[band] = lowest[band - 1]
    lowest[~np.isfinite(lowest)] = 0.0
    return Languages(
        names, idf, np.stack([np.frombuffer(c, dtype=np.float32) for c in fitted["centroid"]]),
        np.array([names.index(n) for n in fitted["lang"]]), lowest.astype(np.float32),
    )


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """``docs`` with lang_pred, score and rejected.

    Only ``text`` is looked at. A text without a letter, empty or null, is
    ``und`` with score 0 and rejected. Columns of ``docs`` with those three
    names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return model.value.predict(texts)

    # Else a filter on what is found would run it once more below.
    predict = predict.asNondeterministic()
    new = ("lang_pred", "score", "rejected")
    kept = [c for c in docs.columns if c not in new]
    held = free_name(docs, "_found")
    found = docs.select(*kept, predict("text").alias(held))
    return found.select(*kept, *(F.col(f"{held}.{name}").alias(name) for name in new))
