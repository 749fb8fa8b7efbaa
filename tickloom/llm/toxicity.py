"""Toxicity by compression distance to two zstandard dictionaries.

zstandard's own training finds what is frequent, and what is frequent in toxic text
is what is frequent in any text, so the dictionaries' contents are chosen here.
The ordinary dictionary holds the commonest words of ordinary text. The toxic
dictionary holds the same and, before them, the word beginnings peculiar to
toxic text: those seen in many different contexts there and hardly elsewhere.
Counting contexts (the word before) and not occurrences keeps copies of one
document from teaching their private words. A text is cut into windows of a few
words; a window's distance is how many bytes less it needs with the toxic
dictionary. The largest distances of a text, compared with thresholds that were
calibrated on labelled rows kept out of the dictionaries, give its score.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WINDOW_WORDS = 12
LEVEL = 6
TOXIC_FROM = 0.3
#: Different texts of one labelled id that are learnt from, at most.
ROWS_PER_ID = 4
_WORD = re.compile(r"\w+")


def windows(text: str | None) -> Iterator[bytes]:
    """The lower-cased words of the whole text, ``WINDOW_WORDS`` at a time."""
    words = _WORD.findall((text or "").lower())
    for start in range(0, len(words), WINDOW_WORDS):
        yield f" {' '.join(words[start:start + WINDOW_WORDS])} ".encode("utf-8", "surrogatepass")


def _compressor(content: bytes):
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress


def distances(texts: list[str | None], ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per text: the three largest window distances and the log of the number of windows; zeros for no words."""
    plain, loaded = _compressor(ordinary), _compressor(toxic)
    found = np.zeros((len(texts), 4))
    for row, text in zip(found, texts, strict=True):
        gains = sorted((len(plain(w)) - len(loaded(w)) for w in windows(text)), reverse=True)
        row[:min(3, len(gains))] = gains[:3]
        row[3] = np.log1p(len(gains))
    return found


@dataclass(frozen=True)
class ToxicityModel:
    """Both dictionaries and the calibration: weights for the distances, then the constant."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.toxic:
            return np.full(len(texts), _logistic(self.weights[-1]))
        features = distances(texts, self.ordinary, self.toxic)
        return _logistic(features @ self.weights[:-1] + self.weights[-1])


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def _contexts(texts: list[str], only: set[str] | None = None, shortest: int = 4, longest: int = 10) -> tuple[Counter, int]:
    """In how many different contexts each word beginning (of ``only``) stands, and how many words there are."""
    seen: dict[str, set[str]] = defaultdict(set)
    total = 0
    for text in texts:
        words = _WORD.findall(text.lower())
        total += len(words)
        for word, before in set(zip(words, ["", *words], strict=False)):
            for end in range(min(shortest, len(word)), min(len(word), longest) + 1):
                if only is None or word[:end] in only:
                    seen[word[:end]].add(before)
    return Counter({piece: len(before) for piece, before in seen.items()}), total


def train_dictionaries(toxic: list[str], ordinary: list[str], *, contexts: int = 5, ratio: float = 40.0,
                       common_words: int = 2000) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary; the latter is empty where nothing is peculiar to toxic text."""
    inside, inside_words = _contexts(toxic)
    frequent = {p: n for p, n in inside.items() if n >= contexts}
    outside, outside_words = _contexts(ordinary, set(frequent))
    peculiar = sorted(
        (p for p, n in frequent.items()
         if n / inside_words >= ratio * (outside[p] + 0.5) / max(outside_words, 1)),
        key=lambda p: (len(p), p), reverse=True,
    )
    pieces: list[str] = []
    for piece in peculiar:
        if not any(piece in longer for longer in pieces):
            pieces.append(piece)
    if not pieces:
        return b"", b""
    pieces.sort(key=lambda p: (inside[p], p))
    words = Counter(w for text in ordinary for w in _WORD.findall(text.lower()))
    commonest = sorted(words, key=lambda w: (-words[w], w))[:common_words]
    base = " ".join(reversed(commonest)).encode("utf-8", "surrogatepass") or b" " * 8
    return base, f" {' '.join(pieces)} ".encode("utf-8", "surrogatepass") + base


def calibrate(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression with a slight ridge, by Newton steps; the last number is the constant."""
    x = np.column_stack([features, np.ones(len(features))])
    found = np.zeros(x.shape[1])
    ridge = np.diag([1e-2 * weights.sum() / len(weights)] * (x.shape[1] - 1) + [1e-9])
    for _ in range(rounds):
        p = _logistic(x @ found)
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (weights * (labels - p)) - ridge @ found)
        found = found + np.clip(step, -4.0, 4.0)
        if np.abs(step).max() < 1e-8:
            break
    return found


def fit_model(texts: list[str], labels: np.ndarray, shares: tuple[float, float], calibrate_from: int = 3) -> ToxicityModel:
    """Fit to labelled texts; ``shares`` are the shares of ordinary and toxic rows among all labelled ones.

    Every third distinct text is kept out of the dictionaries and calibrates.
    With one label only, or nothing peculiar, all texts score that label's share.
    """
    prior = min(max(shares[1], 1e-4), 1 - 1e-4)
    flat = ToxicityModel(b"", b"", np.array([np.log(prior / (1 - prior))]))
    place = {text: n for n, text in enumerate(sorted(set(texts)))}
    held = np.array([place[t] % calibrate_from == 0 for t in texts], dtype=bool)
    distinct = {(t, bool(y)) for t, y, h in zip(texts, labels, held, strict=True) if not h}
    base, loaded = train_dictionaries(sorted(t for t, y in distinct if y), sorted(t for t, y in distinct if not y))
    counts = np.array([(held & (labels == k)).sum() for k in (0, 1)])
    if not loaded or not counts.all():
        return flat
    weights = np.array(shares)[labels[held]] / counts[labels[held]] * held.sum()
    features = distances([t for t, h in zip(texts, held, strict=True) if h], base, loaded)
    return ToxicityModel(base, loaded, calibrate(features, labels[held], weights))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, toxic_rows: int = 1500, ordinary_rows: int = 3000) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    The dictionaries and the calibration are fitted to at most about
    ``toxic_rows`` + ``ordinary_rows`` labelled ids, drawn by a hash, and of an id
    with several rows to at most ``ROWS_PER_ID`` different ones; the shares of the
    labels cover all rows of ``labels``. An id with different labels counts as
    toxic, rows without label or text teach nothing.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(rows.values())
    if not total:
        return ToxicityModel(b"", b"", np.array([-9.0]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1_000_000)) / 1_000_000
    wanted = F.when(F.col("toxic") == 1, toxic_rows / max(rows.get(1, 0), 1)).otherwise(ordinary_rows / max(rows.get(0, 0), 1))
    # At most about toxic_rows + ordinary_rows ids, whatever the size of the table.
    chosen = F.broadcast(marked.where(draw < wanted))
    # Hashes of the texts tell which rows of an id are taken; equal ones count once.
    rank = F.dense_rank().over(Window.partitionBy("doc_id").orderBy("_text"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "_text").orderBy("_text"))
    sample = (
        docs.select("doc_id", "text").where(F.col("text").isNotNull()).withColumn("_text", F.xxhash64("text"))
        .join(chosen, "doc_id").withColumn("_copy", copy).where("_copy = 1")
        .withColumn("_rank", rank).where(F.col("_rank") <= ROWS_PER_ID).select("text", "toxic"))
    shares = (rows.get(0, 0) / total, rows.get(1, 0) / total)

    def fit(drawn: pd.DataFrame) -> pd.DataFrame:
        model = fit_model(drawn["text"].tolist(), drawn["toxic"].to_numpy(dtype=int), shares)
        return pd.DataFrame({"ordinary": [model.ordinary], "toxic": [model.toxic], "weights": [model.weights.tolist()]})

    fitted = (
        sample.groupBy().applyInPandas(fit, "ordinary binary, toxic binary, weights array<double>").collect()
    )
    if not fitted:
        return fit_model([], np.zeros(0, dtype=int), shares)
    model = fitted[0]
    return ToxicityModel(bytes(model["ordinary"]), bytes(model["toxic"]), np.array(model["weights"]))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.3 on); a null or empty text is scored like one without words."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores(texts.tolist()))

    # Else a filter on the score would run it once more below.
    score = score.asNondeterministic()
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
