"""Join of documents on the Jaccard similarity of their word n-gram sets, through prefix trees.

1. Every text becomes the set of its n-grams as sorted 64-bit hashes; documents
   with equal sets form one class, and only classes are compared.
2. The hash range is cut into more slices than two linked sets of that size can
   differ in, so linked sets hold the same n-grams in several slices. The
   contents of a slice are its mark, and classes that share one are a block.
   Classes that share fewer marks than a link implies leave all their blocks. A
   passage that many documents share fills few slices alone, so it holds no
   block together.
3. Within a block the sets, in one order of n-grams, the commonest first, form a
   prefix tree. A set walks it carrying the overlap so far, which all sets below
   a node share, and leaves a subtree once what remains cannot reach the
   overlap needed. Blocks first compare everybody with their most connected
   class; then only blocks that still hold several components are joined whole.
   A block reports links that join two components, not all pairs.

Hashes stand for n-grams: two different n-grams are taken for one with a
probability of about 2**-64 a pair.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import Tables, release_memory
from tickloom.llm.graph import components

#: Linked sets differ in d slices at most; there are d / SPARE + 3 more than that.
SPARE = 6
#: n-grams of one prefix tree, about.
TREE_GRAMS = 500_000
#: Marks of one bucket, about, and marks that a task sorts into buckets at a time.
BUCKET_MARKS = 500_000
EMITTED_MARKS = 600_000
#: How often classes that share too few marks are taken out of the blocks.
PRUNINGS = 3
#: Bits of the map that tells which texts may be first rows of classes: 2 MB.
KEY_BITS = 1 << 24
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def gram_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams; with fewer words, of the whole sequence; empty without words.

    Words are runs of anything but ASCII white space, A-Z lower-cased.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(size, len(words))
    grams = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for k in range(span):
        grams = _mixed(grams * _STEP + hashed[k:len(words) - span + 1 + k])
    return np.unique(grams)


@dataclass(frozen=True)
class Likeness:
    """Two sets link when 100 * intersection >= percent * union."""

    percent: int

    def needed(self, total: int) -> int:
        """The least intersection of two linked sets with ``total`` elements between them."""
        return -(-self.percent * total // (100 + self.percent))

    def differing(self, largest: int) -> int:
        """The most elements in which two linked sets of at most ``largest`` elements differ."""
        return 2 * (100 - self.percent) * largest // (100 + self.percent)


@cache
def size_ranges() -> np.ndarray:
    """Lower bounds of the ranges of set sizes; each is about half as wide again as the one before."""
    bounds = [1, 2]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return np.array(bounds)


def signatures(grams: np.ndarray, rule: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the slices' contents, for each range of sizes in which the larger of two linked sets may lie.

    The low six bits of a mark name the range. The second array holds, for every
    mark, how many marks of its range a set has to share with a linked one.
    """
    bounds = size_ranges()
    own = int(np.searchsorted(bounds, len(grams), side="right")) - 1
    found, needs = [], []
    # The larger set may lie as many ranges higher as the rule allows.
    for level in range(own, len(bounds) - 1):
        if 100 * len(grams) < rule.percent * bounds[level]:
            break
        differing = rule.differing(int(bounds[level + 1]) - 1)
        if not differing:
            continue
        equal = differing // SPARE + 3
        slices = differing + equal
        place = ((grams >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        contents = np.add.reduceat(_mixed(grams * _STEP), starts)
        places = place[starts]
        # Slices empty in both sets are equal too, but make no mark. A set with
        # so many of them that all equal slices may be empty marks those as well.
        need = equal - (slices - len(places))
        if need < 1:
            empty = np.setdiff1d(np.arange(slices, dtype=np.uint64), places)
            places, contents = np.concatenate([places, empty]), np.concatenate([contents, np.zeros_like(empty)])
            need = 1
        marks = _mixed(contents * _STEP + _mixed(places * np.uint64(64) + np.uint64(level)))
        found.append(marks & ~np.uint64(63) | np.uint64(level))
        needs.append(np.full(len(marks), min(need, 65535), dtype=np.uint16))
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint16)
    return np.concatenate(found), np.concatenate(needs)


def marks_of_two(rule: Likeness) -> int:
    """Marks of two n-grams of a class, about: one at 80 and more, many where sets of several ranges may link."""
    if rule.percent >= 80:
        return 1
    grams = np.unique(_mixed(np.arange(1, 1001, dtype=np.uint64) * _STEP))
    return max(1, -(-2 * len(signatures(grams, rule)[0]) // len(grams)))


class PrefixTree:
    """Sets of numbers, each in ascending order, as paths of a tree with whole runs on its edges."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        # Node: the numbers on the edge to it, children, the sets that end here, smallest and largest size below.
        self.root = [np.zeros(0, dtype=np.int64), [], [], 0, 0]
        path = [(self.root, 0)]
        before = np.zeros(0, dtype=np.int64)
        for i in order:
            row = sets[i]
            short = min(len(row), len(before))
            differ = np.flatnonzero(row[:short] != before[:short])
            common = int(differ[0]) if len(differ) else short
            while path[-1][1] > common:
                node, depth = path.pop()
                if path[-1][1] < common:
                    # The edge to ``node`` is cut where the new set leaves it.
                    parent, start = path[-1]
                    upper = [node[0][:common - start], [node], [], 0, 0]
                    node[0] = node[0][common - start:]
                    parent[1][-1] = upper
                    path.append((upper, common))
            if len(row) > common:
                leaf = [row[common:], [], [], 0, 0]
                path[-1][0][1].append(leaf)
                path.append((leaf, len(row)))
            path[-1][0][2].append(i)
            before = row
        self._measure()

    def _measure(self) -> None:
        stack, seen = [self.root], []
        while stack:
            node = stack.pop()
            seen.append(node)
            stack.extend(node[1])
        for node in reversed(seen):
            sizes = [self.sizes[i] for i in node[2]] + [s for child in node[1] for s in child[3:5]]
            node[3], node[4] = (min(sizes), max(sizes)) if sizes else (0, 0)

    def linked(self, has: np.ndarray, size: int, rule: Likeness) -> Iterator[int]:
        """The sets linked with the set of ``size`` numbers that ``has`` marks."""
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            depth += len(node[0])
            overlap += int(np.count_nonzero(has[node[0]]))
            for i in node[2]:
                if overlap >= rule.needed(size + self.sizes[i]):
                    yield i
            for child in node[1]:
                most = overlap + min(size - overlap, child[4] - depth)
                if most >= rule.needed(size + child[3]):
                    stack.append((child, depth, overlap))


def join_block(sets: list[np.ndarray], labels: list[int], queries: list[int], rule: Likeness) -> list[tuple[int, int]]:
    """Links (positions) from ``queries`` that join two of the components given by ``labels``, until none are left."""
    if len(sets) < 2:
        return []
    grams, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(grams), dtype=np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(grams))
    ends = np.cumsum([len(s) for s in sets])
    rows = [np.sort(r) for r in np.split(rank[place], ends[:-1])]
    tree = PrefixTree(rows)
    above: dict[int, int] = {}

    def top(label: int) -> int:
        while above.get(label, label) != label:
            label = above[label]
        return label

    links = []
    has = np.zeros(len(grams), dtype=bool)
    for q in queries:
        has[rows[q]] = True
        for i in tree.linked(has, len(rows[q]), rule):
            mine, other = top(labels[q]), top(labels[i])
            if mine != other:
                above[max(mine, other)] = min(mine, other)
                links.append((q, i))
        has[rows[q]] = False
    return links


def _class_of(grams: np.ndarray) -> int | None:
    """A name for the set: a signed 64-bit hash; none for the empty set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64)) if len(grams) else None


def _with_classes(texts: DataFrame, size: int) -> DataFrame:
    """doc_id, key, n_shingles and class of every row."""

    @F.pandas_udf("n_shingles long, class long")
    def run(batch: pd.Series) -> pd.DataFrame:
        release_memory()
        sets = [gram_set(text, size) for text in batch]
        return pd.DataFrame({
            "n_shingles": [len(s) for s in sets], "class": pd.array([_class_of(s) for s in sets], dtype="Int64")})

    found = texts.select("doc_id", "key", run("text").alias("found"))
    return found.select("doc_id", "key", "found.n_shingles", "found.class")


def _packed_marks(size: int, rule: Likeness, buckets: int):
    """(mark, class) entries as arrays by bucket, some ``EMITTED_MARKS`` of them at a time.

    Of several classes with one mark among these, the first stands for all in
    the mark's bucket (part 0), so that however many share it, a bucket gets one
    entry of them. All of them go, as they are, into a part of their own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks, needs, names, known = [], [], [], set()
        for batch in batches:
            release_memory()
            for text in batch["text"]:
                grams = gram_set(text, size)
                name = _class_of(grams)
                if name is not None and name not in known:
                    known.add(name)
                    found, need = signatures(grams, rule)
                    marks.append(found)
                    needs.append(need)
                    names.append(np.full(len(found), name, dtype=np.int64))
            if sum(map(len, marks)) >= EMITTED_MARKS:
                yield _by_bucket(np.concatenate(marks), np.concatenate(names), np.concatenate(needs), buckets)
                marks, needs, names, known = [], [], [], set()
        if any(map(len, marks)):
            yield _by_bucket(np.concatenate(marks), np.concatenate(names), np.concatenate(needs), buckets)

    return run


def _by_bucket(mark: np.ndarray, name: np.ndarray, need: np.ndarray, buckets: int) -> pd.DataFrame:
    order = np.lexsort((name, mark))
    mark, name, need = mark[order], name[order], need[order]
    again = np.concatenate([[False], mark[1:] == mark[:-1]])
    # Marks are in order, so the bucket of a mark is a range of its values.
    bucket = ((mark >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    repeated = again | np.append(again[1:], False)
    own = xxhash.xxh3_64_intdigest(mark[:1000].tobytes() + name[:1000].tobytes()) >> 2 | 1
    rows = []
    for part, kept in ((0, ~again), (own, repeated)):
        cuts = np.searchsorted(bucket[kept], np.arange(buckets + 1, dtype=np.uint64))
        held = [a[kept] for a in (mark, name, need)]
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            rows.append((int(b), part, *(a[cuts[b]:cuts[b + 1]].tobytes() for a in held)))
    return pd.DataFrame(rows, columns=["bucket", "part", "marks", "classes", "needs"])


def _shared_marks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The entries of a bucket whose mark several classes have; all of a batch's own part, where each is a repetition."""
    release_memory()
    mark = np.frombuffer(b"".join(rows["marks"]), dtype=np.int64)
    name = np.frombuffer(b"".join(rows["classes"]), dtype=np.int64)
    need = np.frombuffer(b"".join(rows["needs"]), dtype=np.uint16)
    if not key[1]:
        order = np.lexsort((name, mark))
        mark, name, need = mark[order], name[order], need[order]
        starts = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
        lengths = np.diff(np.append(starts, len(mark)))
        keep = np.repeat(lengths > 1, lengths)
        mark, name, need = mark[keep], name[keep], need[keep]
    return pd.DataFrame({"mark": mark, "class": name, "need": need.astype(np.int32)})


def text_key(text: str) -> Column:
    """A 64-bit hash of a text, which with the id tells a row from others."""
    return F.xxhash64(F.col(text).cast("binary"))


def ngram_join(docs: DataFrame, *, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text).

    Two rows link when the Jaccard similarity of their sets of ``words``-word
    n-grams reaches ``percent`` / 100; component_id is the smallest doc_id
    reachable by links. Null, empty and wordless texts have no n-grams and no
    links. Repeated rows stay and share their component. An empty table gives
    no rows.
    """
    rows = row_components(docs, words=words, percent=percent)
    return rows.select("doc_id", "n_shingles", F.coalesce("first_id", "doc_id").alias("component_id"))


def row_components(docs: DataFrame, *, words: int, percent: int) -> DataFrame:
    """As ``ngram_join``, but doc_id, key, n_shingles, first_id and first_key.

    ``key`` is the ``text_key``; first_id and first_key are those of one row of
    the component: one with the smallest id, or with the smallest key where all
    ids are null. Both are null for rows without n-grams.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    rule = Likeness(percent)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        text_key("text").alias("key"))
    tables = Tables(docs.sparkSession, "ngram-join")
    members = tables.keep(_with_classes(texts, words), "classes")
    classes = members.where("class IS NOT NULL").groupBy("class").agg(
        *_first_row("doc_id", "key"), F.first("n_shingles").alias("grams"))

    # Blocks: marks that at least two classes share.
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total * marks_of_two(rule) // (2 * BUCKET_MARKS)))
    entries = (
        texts.mapInPandas(_packed_marks(words, rule, buckets), "bucket int, part long, marks binary, classes binary, needs binary")
        .groupBy("bucket", "part").applyInPandas(_shared_marks, "mark long, class long, need int")
    )
    shared = tables.keep(entries, "marks")
    for _ in range(PRUNINGS):
        before, shared = shared, tables.keep(_pruned(shared), "marks")
        tables.drop(before)
    nodes = tables.keep(
        shared.groupBy("class").agg(F.count("*").alias("degree")).join(classes, "class"), "nodes")

    def grams_again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            release_memory()
            sets = [gram_set(t, words) for t in batch["text"]]
            # Another text may have the same key.
            right = [_class_of(s) == name for s, name in zip(sets, batch["class"], strict=True)]
            yield pd.DataFrame({"class": batch["class"], "grams": [s.tobytes() for s in sets]})[right]

    candidates = tables.keep(
        _maybe_in(texts, nodes).join(
            nodes.select("first_id", "first_key", "class"),
            F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key"))).select("class", "text")
        .mapInPandas(grams_again, "class long, grams binary").dropDuplicates(["class"]),
        "sets",
    )

    # Everybody in a block against the most connected class of the block.
    marked = shared.select("mark", "class").join(nodes.select("class", "degree", "grams"), "class")
    hub_of = marked.groupBy("mark").agg(F.max(F.struct("degree", "class")).alias("hub"))
    hubs = tables.keep(
        marked.join(hub_of.select("mark", F.col("hub.class").alias("hub")), "mark")
        .where("class <> hub").select("mark", "class", "grams", "hub"),
        "hubs",
    )
    tables.drop(shared, nodes)
    stars = tables.keep(hubs.groupBy("hub", "class").agg(F.first("grams").alias("grams"), F.count("*").alias("marks")), "stars")
    # First with the hub it shares most marks with, then with the hubs of other components.
    nearest = stars.groupBy("class").agg(F.max(F.struct("marks", "hub")).alias("best")).select("class", "best.hub")
    links = tables.keep(_joined(_dealt(stars.join(nearest, ["hub", "class"]), "hub"), candidates, "hub", rule), "links")
    labels = components(links)
    apart = _labelled(stars.join(nearest, ["hub", "class"], "left_anti"), labels)
    apart = apart.join(_labels_of(labels, "hub"), "hub", "left").where("label <> coalesce(component, hub)")
    more = tables.keep(_joined(_dealt(apart.select("hub", "class", "grams"), "hub"), candidates, "hub", rule), "links")
    links = links.unionByName(more)
    tables.drop(stars)

    # What is left: blocks whose other members still belong to several components.
    # Those with one hub are joined together, so that a set is copied once a hub and not once a mark.
    labelled = _labelled(hubs, components(links))
    split = labelled.groupBy("mark").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low <> _high")
    left = tables.keep(
        labelled.join(split.select("mark"), "mark").groupBy("hub", "class").agg(
            F.first("grams").alias("grams"), F.first("label").alias("label")),
        "open")
    tables.drop(hubs)
    links = tables.keep(links.unionByName(_joined(_dealt_pairs(left), candidates, "hub", rule)), "links")
    tables.drop(candidates, left)

    named = classes.join(_labels_of(components(links), "class"), "class", "left")
    named = named.select("class", "first_id", "first_key", F.coalesce("component", "class").alias("component"))
    lowest = named.groupBy("component").agg(*_first_row("first_id", "first_key"))
    by_class = named.select("class", "component").join(lowest, "component").select("class", "first_id", "first_key")
    return members.join(by_class, "class", "left").select("doc_id", "key", "n_shingles", "first_id", "first_key")


def _maybe_in(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``texts`` but most of those that are no class's first row, without a shuffle of texts.

    The classes' keys set one bit each in a map of bounded size, which every task
    gets as a table of its words; a text stays if its key's bit is set. Beyond
    ``KEY_BITS`` / 16 classes more texts stay than need to; the join behind this
    tells them apart.
    """
    bits = 1 << 16
    while bits < min(KEY_BITS, 16 * nodes.count()):
        bits *= 2

    def word(key: str) -> Column:
        return F.shiftright(F.col(key).bitwiseAND(F.lit(bits - 1)), 6)

    one = F.expr("shiftleft(1L, CAST(first_key & 63L AS INT))")
    held = nodes.select(word("first_key").alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    is_set = F.expr("(shiftrightunsigned(_bits, CAST(key & 63L AS INT)) & 1L) = 1L")
    return texts.join(F.broadcast(held), (word("key") == F.col("_word")) & is_set, "left_semi")


def _first_row(number: str, key: str) -> tuple[Column, Column]:
    """Of one of the rows with the smallest number, or with the smallest key where none has a number."""
    return F.min(number).alias("first_id"), F.coalesce(F.min_by(key, number), F.min(key)).alias("first_key")


def _pruned(shared: DataFrame) -> DataFrame:
    """The marks without classes that share too few, and without marks that one class is left with.

    One shuffle by class and level, of which no class has more rows than its text
    has n-grams, drops repeated entries and counts.
    """
    by_class = Window.partitionBy("class", "level")
    kept = (
        shared.withColumn("level", F.col("mark").bitwiseAND(63)).repartition("class", "level")
        .groupBy("class", "level", "mark").agg(F.max("need").alias("need"))
        .withColumn("_marks", F.count("*").over(by_class)).withColumn("_need", F.max("need").over(by_class))
        .where("_marks >= _need").select("mark", "class", "need")
    )
    several = kept.groupBy("mark").agg(F.min("class").alias("_low"), F.max("class").alias("_high")).where("_low <> _high")
    return kept.join(several.select("mark"), "mark").select("mark", "class", "need")


def _labels_of(labels: DataFrame, name: str) -> DataFrame:
    return labels.withColumnRenamed("node", name)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of their class, as far as links are known."""
    return (
        rows.join(_labels_of(labels, "class"), "class", "left")
        .withColumn("label", F.coalesce("component", "class")).drop("component")
    )


def _dealt(stars: DataFrame, key: str) -> DataFrame:
    """Members of every star in parts of about ``TREE_GRAMS`` n-grams, each with the hub as its one query."""
    parts = stars.groupBy(key).agg(F.ceil(F.sum("grams") / TREE_GRAMS).alias("_parts"))
    dealt = stars.join(parts, key).withColumn("part", F.pmod(F.xxhash64("class"), F.col("_parts")))
    members = dealt.select(key, "part", "class", F.lit(False).alias("asks"), F.col("class").alias("label"))
    asking = dealt.select(key, "part").distinct().select(
        key, "part", F.col(key).alias("class"), F.lit(True).alias("asks"), F.col(key).alias("label"))
    return members.unionByName(asking)


def _dealt_pairs(left: DataFrame) -> DataFrame:
    """Members of open blocks in parts; every part meets every part of its hub, as askers and as members.

    The blocks of a hub with one part are joined with themselves. Only those
    beyond ``TREE_GRAMS`` n-grams have several, and their sets are copied once
    per part.
    """
    parts = left.groupBy("hub").agg(F.ceil(F.sum("grams") / TREE_GRAMS).alias("_parts"))
    dealt = left.join(parts, "hub").withColumn("_own", F.pmod(F.xxhash64("class"), F.col("_parts")))
    meets = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return meets.select(
        "hub", (low * F.col("_parts") + high).alias("part"), "class",
        (F.col("_own") <= F.col("_other")).alias("asks"), "label")


def _joined(rows: DataFrame, candidates: DataFrame, key: str, rule: Likeness) -> DataFrame:
    """Links ``a``, ``b`` (classes) found by a prefix tree over every (key, part)."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        block = block.drop_duplicates("class").sort_values("class", ignore_index=True)
        sets = [np.frombuffer(g, dtype=np.uint64) for g in block["grams"]]
        names = block["class"].tolist()
        asks = np.flatnonzero(block["asks"].to_numpy(dtype=bool)).tolist()
        links = join_block(sets, block["label"].tolist(), asks, rule)
        return pd.DataFrame({"a": [names[i] for i, _ in links], "b": [names[j] for _, j in links]}, dtype=np.int64)

    full = rows.join(candidates, "class").select(key, "part", "class", "asks", "label", "grams")
    return full.groupBy(key, "part").applyInPandas(run, "a long, b long")
