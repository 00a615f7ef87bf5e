"""Ranked lexical search: each item's best documents by branch and bound on a frequent-pattern tree of documents.

Terms are the runs of letters and digits of the whole text (every character beyond ASCII is one), only A-Z lower-cased.  A term's weight is
w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 10 + 90 n N div L, and its score sums w ((1000000000 tf) div (1000 tf + 8 m))
over the item's terms, once each.  N, L and df are those of all documents.

Method: documents are restricted to the terms of the items that have a weight, ordered by falling document frequency, and put into a tree in
which equal beginnings share a path; paths without a branch are one node, and neighbouring branches of few documents one bucket.  Every node
knows the largest tf of each term and the least m below it, and so an upper bound of all scores there: tf raises a term's part of the
score, m lowers it, and rounding keeps the order.  An item goes through the tree depth first, the most promising branch first, and leaves out every node
whose bound does not reach the k-th best score it has found; the documents of the buckets it enters are scored in whole numbers.
The items go through a tree together, each with a bound and a k-th best of its own.

A tree has ``TREE_TERMS`` terms of documents at most (or one document).  What a task has found in one tree is the bar of the next, and a task sends each item's best
only.  Items are packed by the number of their terms, so what is sent to tasks and counted on the driver is bounded by
``PACK_TERMS`` terms and those of one item; the documents are read once for each pack.

Null texts have no terms; documents without terms and items without known terms have no row.  Rows with one item_id are one item with the terms
of all of them; a null item_id is an id like any other.  Repeated rows are documents each; a null doc_id is ranked after equal scores
with one.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimill.llm.common import map_batches
from sentimill.plans.running import running_totals
from sentimill.plans.staging import stage

K = 10
#: Terms of the items of a pack, beyond those of its last item; an item counts as so many more.
PACK_TERMS = 50_000
ITEM_TERMS = 25
#: Terms of the documents of one tree, and documents of a bucket.
TREE_TERMS = 1 << 19
BUCKET = 8
#: Bounds that are worked out at once.
CELLS = 1 << 21

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FROM, _TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8."""
    # bytes.lower() knows ASCII only.
    return _TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its different terms, by number of terms in packs."""
    lowered = F.translate(F.coalesce("text", F.lit("")), _FROM, _TO)
    found = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lowered, F.lit(_TERM_SQL), F.lit(0))).alias("term")
    )
    own = stage(found.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms")), "items")
    # A null id stands before all others.
    placed = own.select("*", (F.size("terms") + ITEM_TERMS).cast("long").alias("n"), F.col("item_id").isNotNull().alias("named"))
    ordered = running_totals(placed, ["named", "item_id"], {"until": "n"})
    return stage(
        ordered.select("item_id", "terms", F.floor((F.col("until") - F.col("n")) / PACK_TERMS).alias("pack")), "packs"
    )


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, and places and counts of the terms of ``vocabulary``, of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: i for i, term in enumerate(shared.value)}
        for frame in frames:
            ids, lengths, places, counts = [], [], [], []
            for doc_id, text in zip(frame.column("doc_id").to_pylist(), frame.column("text").to_pylist(), strict=True):
                found = terms(text)
                if not found:
                    continue
                known = np.array([place[t] for t in found if t in place], dtype=np.int32)
                own, n = np.unique(known, return_counts=True)
                ids.append(doc_id)
                lengths.append(len(found))
                places.append(own)
                counts.append(n.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "places", "counts"],
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(columns, batches, "doc_id long, n long, places array<int>, counts array<long>")


@dataclass
class Items:
    """The items of a pack over the ranked terms: rank 0 is the most frequent one."""

    ids: list  # item ids
    ranks: np.ndarray  # rank of each place of the vocabulary; -1 without a weight
    weights: np.ndarray  # by rank
    starts: np.ndarray  # by rank: where its items begin
    items: np.ndarray  # places of the items of each rank
    documents: int
    words: int

    def m(self, n: np.ndarray) -> np.ndarray:
        # Whole numbers of any size, since 90 n N may pass 64 bits.
        if len(n) and 90 * int(n.max()) * self.documents > 2**62:
            return np.array([10 + 90 * int(x) * self.documents // self.words for x in n], dtype=np.int64)
        return 10 + 90 * n * self.documents // self.words

    def parts(self, ranks: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """What a term adds to a score."""
        return self.weights[ranks] * (1_000_000_000 * tf // (1000 * tf + 8 * m))

    def scores(self, ranks: np.ndarray, parts: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Sums of the parts for ``n`` rows and all items."""
        first, size = self.starts[ranks], self.starts[ranks + 1] - self.starts[ranks]
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cell = np.repeat(rows, size) * len(self.ids) + self.items[at]
        part = np.repeat(parts, size)
        # Sums of doubles are exact below 2**53, so both halves are summed on their own.
        high = np.bincount(cell, part >> 24, n * len(self.ids)).astype(np.int64)
        low = np.bincount(cell, part & 0xFFFFFF, n * len(self.ids)).astype(np.int64)
        return ((high << 24) + low).reshape(n, len(self.ids))


@dataclass
class Node:
    """Documents ``begin`` to ``end`` of the tree's order; a bucket has no children."""

    begin: int
    end: int
    children: list[Node]
    ranks: np.ndarray | None = None
    tf: np.ndarray | None = None
    m: int = 0


class Tree:
    """The frequent-pattern tree of some documents: (id, has an id, m, ranks in order, tf)."""

    def __init__(self, documents: list[tuple[int, bool, int, np.ndarray, np.ndarray]]) -> None:
        # Big-endian bytes sort as the numbers do.
        documents = sorted(documents, key=lambda d: d[3].astype(">i4").tobytes())
        self.ids = np.array([d[0] for d in documents], dtype=np.int64)
        self.named = np.array([d[1] for d in documents], dtype=bool)
        self.m = np.array([d[2] for d in documents], dtype=np.int64)
        self.sizes = np.array([len(d[3]) for d in documents])
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.ranks = np.concatenate([d[3] for d in documents])
        self.tf = np.concatenate([d[4] for d in documents])
        self.nodes = self._branches()
        # Children come after their parents.
        for node in reversed(self.nodes):
            self._measure(node)
        self.root = self.nodes[0]

    def _branches(self) -> list[Node]:
        nodes = [Node(0, len(self.ids), [])]
        waiting = [(nodes[0], 0)]
        while waiting:
            node, depth = waiting.pop()
            if node.end - node.begin <= BUCKET:
                continue
            depth, parts = self._parts(node, depth)
            for begin, end, goes_on in parts:
                child = Node(begin, end, [])
                node.children.append(child)
                nodes.append(child)
                if goes_on:
                    waiting.append((child, depth + 1))
        return nodes

    def _parts(self, node: Node, depth: int) -> tuple[int, list[tuple[int, int, bool]]]:
        """Where the documents of a node part, and the parts: (begin, end, whether it is a branch of its own)."""
        begin, end = node.begin, node.end
        # Documents in order: what the first and the last share, all share.
        one = self.ranks[self.starts[begin] : self.starts[begin + 1]]
        two = self.ranks[self.starts[end - 1] : self.starts[end]]
        size = min(len(one), len(two))
        differ = np.flatnonzero(one[depth:size] != two[depth:size])
        depth = depth + int(differ[0]) if len(differ) else size
        goes_on = self.sizes[begin:end] > depth
        branch = np.where(goes_on, self.ranks[np.where(goes_on, self.starts[begin:end] + depth, 0)], -1)
        edges = [begin, *(begin + 1 + np.flatnonzero(branch[1:] != branch[:-1])).tolist(), end]
        parts, waiting = [], begin
        for at, until in zip(edges[:-1], edges[1:], strict=True):
            large = until - at > BUCKET
            if waiting < at and (large or until - waiting > BUCKET):
                parts.append((waiting, at, False))
                waiting = at
            if large and branch[at - begin] >= 0:
                parts.append((at, until, True))
            elif large:
                # Documents that end here are alike.
                parts += [(i, min(i + BUCKET, until), False) for i in range(at, until, BUCKET)]
            if large:
                waiting = until
        if waiting < end:
            parts.append((waiting, end, False))
        return depth, parts

    def _measure(self, node: Node) -> None:
        """Find the largest tf of each term and the least m."""
        if node.children:
            ranks = np.concatenate([c.ranks for c in node.children])
            tf = np.concatenate([c.tf for c in node.children])
        else:
            ranks = self.ranks[self.starts[node.begin] : self.starts[node.end]]
            tf = self.tf[self.starts[node.begin] : self.starts[node.end]]
        order = np.argsort(ranks, kind="stable")
        ranks, tf = ranks[order], tf[order]
        first = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(ranks) else np.zeros(0, np.int64)
        node.ranks = ranks[first]
        node.tf = np.maximum.reduceat(tf, first) if len(first) else tf
        node.m = int(self.m[node.begin : node.end].min())


class Search:
    """The best ``k`` documents of every item so far."""

    def __init__(self, items: Items, k: int = K) -> None:
        self.items, self.k = items, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items.ids]
        self.bar = np.zeros(len(items.ids), dtype=np.int64)  # the k-th best score, 0 while there are fewer
        self.scored = 0  # pairs of document and item
        self.all = 0

    def visit(self, tree: Tree) -> None:
        self.all += len(tree.ids) * len(self.items.ids)
        # Nodes with the items that may enter them and those items' bounds.
        everyone = np.arange(len(self.items.ids))
        waiting = [(tree.root, everyone, self._bounds([tree.root])[0])]
        while waiting:
            node, asking, bounds = waiting.pop()
            asking = asking[(bounds >= self.bar[asking]) & (bounds > 0)]
            if not len(asking):
                continue
            if not node.children:
                self._score(tree, node, asking)
                continue
            found = []
            step = max(1, CELLS // len(self.items.ids))
            for at in range(0, len(node.children), step):
                some = node.children[at : at + step]
                of_some = self._bounds(some)[:, asking]
                gains = of_some - self.bar[asking]
                enters = (gains >= 0) & (of_some > 0)
                found += [(int(g[e].max()), c, asking[e], b[e]) for c, e, b, g in zip(some, enters, of_some, gains, strict=True) if e.any()]
            # The branch that may exceed the bars most is taken first.
            found.sort(key=lambda child: child[0])
            waiting += [child[1:] for child in found]

    def _bounds(self, nodes: list[Node]) -> np.ndarray:
        rows = np.repeat(np.arange(len(nodes)), [len(n.ranks) for n in nodes])
        ranks, tf = np.concatenate([n.ranks for n in nodes]), np.concatenate([n.tf for n in nodes])
        m = np.array([n.m for n in nodes], dtype=np.int64)[rows]
        return self.items.scores(ranks, self.items.parts(ranks, tf, m), rows, len(nodes))

    def _score(self, tree: Tree, bucket: Node, asking: np.ndarray) -> None:
        begin, end = bucket.begin, bucket.end
        rows = np.repeat(np.arange(end - begin), tree.sizes[begin:end])
        some = slice(tree.starts[begin], tree.starts[end])
        parts = self.items.parts(tree.ranks[some], tree.tf[some], tree.m[begin:end][rows])
        scores = self.items.scores(tree.ranks[some], parts, rows, end - begin)[:, asking]
        self.scored += scores.size
        # An equal score can win by its id.
        enters = (scores >= self.bar[asking]) & (scores > 0)
        for i in np.flatnonzero(enters.any(axis=0)).tolist():
            new = np.flatnonzero(enters[:, i])
            self._add(int(asking[i]), scores[new, i], tree.ids[begin + new], tree.named[begin + new])

    def _add(self, item: int, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        old = self.best[item]
        scores, ids, named = (np.concatenate(both) for both in zip(old, (scores, ids, named), strict=True))
        order = np.lexsort((ids, ~named, -scores))[: self.k]
        self.best[item] = scores[order], ids[order], named[order]
        if len(order) == self.k:
            self.bar[item] = self.best[item][0][-1]


def _trees(frames: Iterator[pa.RecordBatch], items: Items) -> Iterator[Tree]:
    waiting: list[tuple[int, bool, int, np.ndarray, np.ndarray]] = []
    size = 0
    for frame in frames:
        m = items.m(frame.column("n").to_numpy())
        ids = frame.column("doc_id").to_pylist()
        columns = frame.column("places"), frame.column("counts")
        values = [column.flatten().to_numpy(zero_copy_only=False) for column in columns]
        ends = np.cumsum(columns[0].value_lengths().to_numpy(zero_copy_only=False))
        begin = 0
        for i, end in enumerate(ends.tolist()):
            ranks, tf = items.ranks[values[0][begin:end]], values[1][begin:end].astype(np.int64)
            begin = end
            ranks, tf = ranks[ranks >= 0], tf[ranks >= 0]
            if not len(ranks):
                continue
            if size + len(ranks) > TREE_TERMS and waiting:
                yield Tree(waiting)
                waiting, size = [], 0
            order = np.argsort(ranks)
            waiting.append((ids[i] if ids[i] is not None else 0, ids[i] is not None, int(m[i]), ranks[order], tf[order]))
            size += len(ranks)
    if waiting:
        yield Tree(waiting)


def _ranked_items(own: list, vocabulary: list[bytes], frequencies: dict[int, int], documents: int, words: int) -> Items:
    place = {term: i for i, term in enumerate(vocabulary)}
    df = np.array([frequencies.get(i, 0) for i in range(len(vocabulary))], dtype=np.float64)
    weight = np.floor(1000.0 * np.log((2.0 * documents + 2.0) / (2.0 * df + 1.0))).astype(np.int64)
    # A term that no document has, or whose weight is zero, adds nothing to any score.
    used = np.flatnonzero((df > 0) & (weight > 0))
    order = used[np.lexsort((used, -df[used]))]
    ranks = np.full(len(vocabulary), -1, dtype=np.int32)
    ranks[order] = np.arange(len(order))
    pairs = [(int(ranks[place[t.encode()]]), i) for i, row in enumerate(own) for t in row["terms"]]
    pairs = np.array(sorted(p for p in pairs if p[0] >= 0), dtype=np.int64).reshape(-1, 2)
    starts = np.searchsorted(pairs[:, 0], np.arange(len(order) + 1))
    return Items([row["item_id"] for row in own], ranks, weight[order], starts, pairs[:, 1], documents, max(1, words))


def _search_pack(docs: DataFrame, own: list, k: int) -> DataFrame:
    vocabulary = sorted({t.encode() for row in own for t in row["terms"]})
    written = stage(vectors(docs, vocabulary), "vectors")
    total = written.agg(F.count("*").alias("n"), F.sum("n").alias("words")).first()
    counted = written.select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("df")).collect()
    items = _ranked_items(own, vocabulary, {r["place"]: r["df"] for r in counted}, total["n"], total["words"] or 0)
    shared = docs.sparkSession.sparkContext.broadcast(vars(items))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(Items(**shared.value), k)
        for tree in _trees(frames, search.items):
            search.visit(tree)
        for item_id, (scores, ids, named) in zip(search.items.ids, search.best, strict=True):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item_id] * len(scores), pa.int64()),
                        pa.array(ids, pa.int64(), mask=~named), pa.array(scores, pa.int64()),
                    ],
                    names=["item_id", "doc_id", "score"],
                )

    return stage(written.mapInArrow(batches, "item_id long, doc_id long, score long"), "found")


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item."""
    packed = item_terms(items)
    packs = [row["pack"] for row in packed.select("pack").distinct().orderBy("pack").toLocalIterator()]
    found = [_search_pack(docs, packed.filter(F.col("pack") == pack).orderBy("item_id").collect(), k) for pack in packs]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
