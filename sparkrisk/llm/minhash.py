"""Near-duplicates by an inverted join of MinHash coordinates (operator 5).

1. A text's set is its distinct ``shingle``-word shingles (hashed, ASCII lower case). Texts with
   equal sets are one class, represented by its smallest id.
2. Each representative is posted under the value of each of ``coordinates`` MinHash functions.
   Two sets of similarity ``s`` collide in a share ``s`` of them, so true links collide in
   ``matches`` or more (with 48 and 26, all but about one in 1e5 at exactly 0.8).
3. Values that one document has collide with nothing. A document needs ``matches`` other values;
   of those it keeps its rarest ones: two documents with ``matches`` collisions share a value even
   among all but their ``matches - 1`` most frequent (prefix filter), so the longest posting
   lists are skipped.
4. Documents that share a kept value, directly or through others, form a cluster. Clusters are
   dealt to tasks in chunks of a bounded number of shingles. A chunk has an inverted list of its
   documents for each coordinate value. A document merges its shortest lists, all but
   ``matches - 1`` (prefix), and skips the long ones: the documents found are counted on the whole
   signatures, those with ``matches`` collisions or more are kept, and these are confirmed on the
   full sets. The best connected document of a chunk comes first; pairs inside one component
   need no counting, every pair that could still join two components gets it. Documents outside
   their cluster's largest component then meet the cluster's other chunks, but only those that
   hold one of their kept values.
5. Links (a spanning set of them) give the components.

Defined results: null and empty texts have an empty set and no links; fewer words than a
shingle has form one shingle. Rows with equal ids and texts count once and have equal results; of
rows with equal ids and different texts each has its own text's component (texts that such an
id represents both count as linked). Rows with a null id are linked with nothing, have a null
component and are kept.
Other columns are ignored or, in ``near_duplicates``, not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import join_small, stage
from sparkrisk.llm.components import components
from sparkrisk.llm.wordhash import Runs, mix, utf8, words

COORDINATES = 48
MATCHES = 26
# Shingles that a chunk of a cluster brings into one task, about: some 2 MB of sets.
CHUNK_SHINGLES = 250_000
SEED = 5
MAX_BROADCAST_IDS = 500_000


def shingle_sets(column, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of distinct shingles in rising order text by text, set size of each text)."""
    data, offsets = utf8(column)
    word, _, _, per_text = words(data, offsets, lower=True)
    runs = Runs(word)
    first = np.cumsum(per_text) - per_text
    count = np.where(per_text >= shingle, per_text - shingle + 1, np.minimum(per_text, 1))
    text = np.repeat(np.arange(len(count)), count)
    start = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    value = runs.hash(start, np.minimum(per_text[text], shingle))
    by = np.lexsort((value, text))
    value, text = value[by], text[by]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.bincount(text[new], minlength=len(count))


def _numbers(coordinates: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Factor and mask of every MinHash function."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(1, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factor, rng.integers(1, 1 << 63, coordinates, dtype=np.uint64)


def _signature_rows(value: np.ndarray, size: np.ndarray, factor: np.ndarray, own: np.ndarray) -> np.ndarray:
    """One row of coordinates per text, from ``shingle_sets``; zeros for an empty set."""
    full = np.nonzero(size)[0]
    start = (np.cumsum(size) - size)[full]
    sig = np.zeros((len(size), len(factor)), dtype=np.uint64)
    if len(full):
        for k in range(len(factor)):
            sig[full, k] = mix(np.minimum.reduceat(value * factor[k], start) ^ own[k])
    return sig


def signatures(docs: DataFrame, key: str, text: str, shingle: int, coordinates: int) -> DataFrame:
    """(doc long, n_shingles long, h1 long, h2 long, signature array<long>); the hashes and the
    signature are null for an empty set."""
    import pyarrow as pa

    factor, own = _numbers(coordinates)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            value, size = shingle_sets(batch.column(1), shingle)
            full = np.nonzero(size)[0]
            start = (np.cumsum(size) - size)[full]
            sig = _signature_rows(value, size, factor, own)
            h = np.zeros((2, len(size)), dtype=np.uint64)
            if len(full):
                h[0, full] = np.add.reduceat(mix(value + np.uint64(1)), start)
                h[1, full] = np.add.reduceat(mix(value ^ own[0]), start)
            none = size == 0
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (len(size) + 1) * coordinates, coordinates, dtype=np.int32)),
                pa.array(sig.view(np.int64).ravel()), mask=pa.array(none))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size.astype(np.int64)), pa.array(h[0].view(np.int64), mask=none),
                 pa.array(h[1].view(np.int64), mask=none), lists], names=["doc", "n_shingles", "h1", "h2", "signature"])

    rows = docs.select(docs[key].cast("long").alias("doc"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc long, n_shingles long, h1 long, h2 long, signature array<long>")


def candidates(representatives: DataFrame, matches: int) -> DataFrame:
    """(doc, grp, weight): the posting values each document keeps, see step 3, and how many
    postings all its values have. ``representatives``: (doc, signature)."""
    posts = representatives.select("doc", F.explode("signature").alias("grp"))
    often = posts.groupBy("grp").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = posts.join(often, "grp").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("df", "grp"))).alias("p"))
    shared = shared.filter(F.size("p") >= matches).withColumn(
        "weight", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["df"]))
    kept = shared.select("doc", "weight", F.explode(F.expr(f"slice(p, 1, size(p) - {matches} + 1)")).alias("p"))
    return kept.select("doc", F.col("p.grp").alias("grp"), "weight")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (distinct, rising) have a similarity of at least ``percent`` hundredths."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int(np.count_nonzero(b[at] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


class _Postings:
    """The documents of one chunk, posted under each of their coordinate values."""

    def __init__(self, signatures: list[np.ndarray], matches: int):
        self.signatures, self.matches = np.stack(signatures), matches
        flat = self.signatures.ravel()
        by = np.argsort(flat, kind="stable")
        self.doc = by // self.signatures.shape[1]
        self.value, self.start, self.count = np.unique(flat[by], return_index=True, return_counts=True)

    def colliding(self, own: np.ndarray) -> np.ndarray:
        """Documents that share ``matches`` coordinates or more with the signature ``own``: whoever
        does is in one of its lists even without the ``matches - 1`` longest."""
        at = np.minimum(np.searchsorted(self.value, own), len(self.value) - 1)
        at = at[self.value[at] == own]
        if len(at) < self.matches:
            return np.zeros(0, np.int64)
        at = at[np.argsort(self.count[at], kind="stable")][: len(at) - self.matches + 1]
        found = np.unique(np.concatenate([self.doc[a : a + n] for a, n in zip(self.start[at].tolist(), self.count[at].tolist())]))
        return found[np.count_nonzero(self.signatures[found] == own, axis=1) >= self.matches]

    def busiest(self) -> int:
        """The document whose values are posted most often."""
        often = self.count[np.searchsorted(self.value, self.signatures)]
        return int(np.argmax(often.sum(axis=1)))


class _Union:
    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = self.parent[up]
            x = up
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def _links_inside(docs: list[int], signatures: list[np.ndarray], sets: list[np.ndarray], percent: int, matches: int,
                  hub: int | None) -> list[tuple[int, int]]:
    """Links that span the components of one chunk; ``hub``: the document to begin with."""
    posted, union, out = _Postings(signatures, matches), _Union(), []
    hub = posted.busiest() if hub is None else hub
    for i in [hub, *range(len(docs))]:
        if i != hub and union.find(docs[i]) == union.find(docs[hub]):
            continue  # pairs inside the hub's component join nothing; pairs leaving it are met from outside
        for j in posted.colliding(signatures[i]).tolist():
            if union.find(docs[i]) != union.find(docs[j]) and _similar(sets[i], sets[j], percent):
                union.join(docs[i], docs[j])
                out.append((docs[i], docs[j]))
    return out


def _groups(batches: Iterator, keys: int) -> Iterator[tuple[tuple, list]]:
    """Rows of sorted Arrow batches, grouped by their first ``keys`` columns."""
    held, at = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if at is not None and row[:keys] != at:
                yield at, held
                held = []
            at = row[:keys]
            held.append(row[keys:])
    if held:
        yield at, held


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
                    coordinates: int = COORDINATES, matches: int = MATCHES, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``."""
    import pyarrow as pa

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = stage(signatures(docs, key, text, shingle, coordinates), "signatures")
    classes = signed.filter("h1 is not null and doc is not null").groupBy("h1", "h2").agg(F.min("doc").alias("rep"))
    classes = stage(classes, "classes")
    # A document represents its class by its id and its hashes (repeated ids may have other texts).
    reps = signed.join(classes.select("h1", "h2", F.col("rep").alias("doc")), ["h1", "h2", "doc"])
    posted = stage(candidates(reps.dropDuplicates(["h1", "h2", "doc"]).select("doc", "signature"), matches), "postings")
    clusters = components(posted)

    # Chunks of clusters, with full sets.
    sized = clusters.join(signed.groupBy("doc").agg(F.max("n_shingles").alias("n")), "doc")
    total = sized.groupBy("label").agg(F.sum("n").alias("total")).select(
        F.col("label").alias("cluster"), F.ceil(F.col("total") / chunk_shingles).cast("int").alias("chunks"))
    chunked = stage(sized.join(total, F.col("label") == F.col("cluster")).select(
        "doc", "cluster", "chunks", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int").alias("chunk")), "chunks")
    # Clusters of several chunks: one document with many postings visits all of them.
    several = chunked.filter("chunks > 1")
    weights = posted.groupBy("doc").agg(F.max("weight").alias("weight"))
    hubs = several.join(weights, "doc").groupBy("cluster", "chunks").agg(F.max(F.struct("weight", "doc"))["doc"].alias("doc"))
    visits = hubs.select("doc", "cluster", "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("hub"))
    dealt = chunked.select("*", F.lit(False).alias("hub")).unionByName(visits)
    texts = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    wanted = texts.join(dealt.hint("shuffle_hash"), F.col("id") == F.col("doc")).select("cluster", "chunk", "hub", "doc", "text")

    def with_sets(batches: Iterator) -> Iterator:
        for batch in batches:
            value, size = shingle_sets(batch.column(4), shingle)
            raw, ends = value.tobytes(), np.cumsum(size) * 8
            sets = [raw[a:z] for a, z in zip((ends - size * 8).tolist(), ends.tolist())]
            sig = [row.tobytes() for row in _signature_rows(value, size, factor, own)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sig, pa.binary()), pa.array(sets, pa.binary())],
                                             names=["cluster", "chunk", "hub", "doc", "signature", "shingles"])

    factor, own = _numbers(coordinates)
    sets = stage(wanted.mapInArrow(
        with_sets, "cluster long, chunk int, hub boolean, doc long, signature binary, shingles binary"), "sets")

    def inside(batches: Iterator) -> Iterator:
        for _, rows in _groups(batches, 2):
            rows = [(d, np.frombuffer(g, np.uint64), np.frombuffer(s, np.uint64), h) for h, d, g, s in rows if s]
            hub = 0 if rows and rows[0][3] else None
            out = _links_inside(*([r[i] for r in rows] for i in range(3)), percent, matches, hub) if len(rows) > 1 else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    by_chunk = sets.repartition(parts, "cluster", "chunk").sortWithinPartitions("cluster", "chunk", F.desc("hub"), "doc")
    links = stage(by_chunk.mapInArrow(inside, "a long, b long"), "links")

    if not several.isEmpty():
        links = links.unionByName(_links_across(sets.filter("not hub").drop("hub"), several, hubs, posted, links, percent, matches, parts))

    pairs = links.select(F.explode(F.array("a", "b")).alias("doc"), F.xxhash64("a", "b").alias("grp"))
    joined = components(stage(pairs, "pairs"))
    of_class = classes.join(joined, F.col("rep") == F.col("doc"), "left").select(
        "h1", "h2", F.coalesce("label", "rep").alias("component"))
    out = signed.join(of_class, ["h1", "h2"], "left")
    kind = docs.schema[key].dataType
    component = F.coalesce(F.col("component"), F.col("doc")).cast(kind)
    return out.select(F.col("doc").cast(kind).alias(key), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest (for one of its texts, where an
    id is repeated). Rows with a null id stay."""
    found = near_duplicates(docs, key, **options)
    gone = stage(found.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("kept").alias("kept")).filter("not kept").select(
        F.col(key).alias("__gone")), "dropped")
    return join_small(docs, gone, docs[key] == F.col("__gone"), "left_anti", MAX_BROADCAST_IDS)


def _links_across(sets: DataFrame, chunked: DataFrame, hubs: DataFrame, posted: DataFrame, links: DataFrame, percent: int,
                  matches: int, parts: int) -> DataFrame:
    """Links between chunks of one cluster: documents outside the component of its hub meet the
    other chunks that hold one of their kept values."""
    import pyarrow as pa

    pairs = links.select(F.explode(F.array("a", "b")).alias("doc"), F.xxhash64("a", "b").alias("grp"))
    known = components(stage(pairs, "pairs"))
    labelled = chunked.join(known, "doc", "left").select("doc", "cluster", "chunk", F.coalesce("label", "doc").alias("label"))
    main = hubs.join(known, "doc", "left").select("cluster", F.coalesce("label", "doc").alias("main"))
    outside = labelled.join(main, "cluster").filter("label <> main").select("doc", F.col("chunk").alias("home"))
    # The chunks of every list are counted once, however long it is; a document goes to each chunk once.
    holding = posted.join(chunked, "doc").select("grp", "chunk").distinct()
    visits = posted.join(outside, "doc").join(holding, "grp").filter("home <> chunk").select("doc", "chunk").distinct()
    rows = sets.join(labelled.select("doc", "label"), "doc")
    # Only documents that share a kept value with an asking one travel again.
    asked = posted.join(outside, "doc").select("grp").distinct()
    met = posted.join(asked, "grp").select("doc").distinct()
    members = rows.join(met, "doc").select("cluster", "chunk", F.lit(False).alias("asks"), "doc", "label", "signature", "shingles")
    asking = rows.drop("chunk").join(visits, "doc").select(
        "cluster", "chunk", F.lit(True).alias("asks"), "doc", "label", "signature", "shingles")

    def run(batches: Iterator) -> Iterator:
        for _, group in _stream(batches):
            posts, docs, union = None, [], _Union()
            signatures: list[np.ndarray] = []
            held: list[np.ndarray] = []
            out = []
            for asks, doc, label, signature, raw in group:
                if not raw:
                    continue
                signature, own = np.frombuffer(signature, np.uint64), np.frombuffer(raw, np.uint64)
                union.join(doc, label)
                if not asks:
                    docs.append(doc)
                    signatures.append(signature)
                    held.append(own)
                    continue
                if not docs:
                    continue
                posts = posts or _Postings(signatures, matches)
                for j in posts.colliding(signature).tolist():
                    if union.find(doc) != union.find(docs[j]) and _similar(own, held[j], percent):
                        union.join(doc, docs[j])
                        out.append((doc, docs[j]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    work = members.unionByName(asking).repartition(parts, "cluster", "chunk").sortWithinPartitions("cluster", "chunk", "asks", "doc")
    return stage(work.mapInArrow(run, "a long, b long"), "links")


def _stream(batches: Iterator) -> Iterator[tuple[tuple, Iterator]]:
    """Groups of sorted rows by their first two columns, each read row by row."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, group in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2:] for r in group)
