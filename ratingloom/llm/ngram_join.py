"""Exact n-gram Jaccard join with set-relation skipping.

Sets of word shingles link when 100 * intersection >= 75 * union. Equal sets are one
class and meet once. Of each class the shingles of its prefix are indexed: the first
n - ceil(0.75 n) + 1 in one order of all shingles, frequent ones last, so that two
linked sets share an indexed shingle.

* Index-level skipping: entries of a list are ordered by set size and carry their place
  in the prefix. A list is cut into runs of comparable sizes, and an entry is skipped
  when the shingles behind the two places can no longer give the needed overlap.
* Answer-level skipping: first each run is compared with its smallest set only. What
  that links is one component, and lists within a component are done. Every class has a
  sketch, which bounds from below in how many elements two sets differ. The components of
  a list are then bridged by a tree of its closest sketches, fewer pairs than entries. Then,
  across components, a pair is compared only if it can link at all: by its sketches, and
  as |u & v| <= |u & p| + |v - p| for every set p that both were compared with.

No pair of different components whose sets can link is left out, so the components are
exact. Defined results: null or wordless texts have no shingles, are linked with nothing
and form a component each; rows that repeat a doc_id share its class if the texts do; a
null doc_id is ignored where a smallest doc_id is sought.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import BROADCAST_ROWS, small, staged
from ratingloom.llm.graph import components
from ratingloom.llm.shingles import shingle_sets

#: Frequent shingles known to all tasks, at most; they order the index and change no result.
MOST_FREQUENT = 1_000_000
#: Shingles counted at once by a task, and entries of one list of a frequent shingle.
COUNTED_AT_ONCE, LIST_LENGTH = 4_000_000, 4096
CLASS_BYTES = 8
#: A sketch holds the parity of a set's hashes in 64 times so many buckets.
SKETCH_WORDS = 8
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
#: Turns in which the components of a list are bridged, at most; one is enough where no list is cut.
MOST_TURNS = 3


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _class(digest: bytes, at: int) -> int:
    return int.from_bytes(digest[at : at + CLASS_BYTES], "big", signed=True)


def _sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities by bucket: sets u and v differ in at least as many elements as their sketches do in bits."""
    bucket = (hashes % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    return np.packbits((np.bincount(bucket, minlength=64 * SKETCH_WORDS) & 1).astype(np.uint8)).view(np.int64)


def _differing(x: str, y: str) -> str:
    """SQL for the bits in which the sketches of x and y differ."""
    return " + ".join(f"bit_count({x}.{s} ^ {y}.{s})" for s in SKETCH)


def _described(batches):
    """n, digest and sketch of every set, and how often shingles repeat among the distinct sets of a stretch of rows."""
    held, size, seen, id_type = [], 0, set(), None

    def repeated():
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        more = counts > 1
        return pa.RecordBatch.from_arrays(
            [
                pa.nulls(int(more.sum()), id_type),
                pa.array(counts[more]),
                pa.nulls(int(more.sum()), pa.binary()),
                pa.array(hashes[more].view(np.int64)),
                *(pa.nulls(int(more.sum()), pa.int64()) for _ in SKETCH),
            ],
            ["doc_id", "n", "digest", "shingle", *SKETCH],
        )

    for batch in batches:
        id_type = batch.column("doc_id").type
        counts, digests, sketches = [], [], [np.zeros((0, SKETCH_WORDS), np.int64)]
        for hashes in shingle_sets(batch.column("text").to_pylist()):
            digests.append(_digest(hashes))
            counts.append(len(hashes))
            sketches.append(_sketch(hashes)[None])
            if digests[-1] not in seen:
                seen.add(digests[-1])
                held.append(hashes)
                size += len(hashes)
            if size >= COUNTED_AT_ONCE:
                yield repeated()
                held, size, seen = [], 0, set()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.nulls(len(counts), pa.int64()),
                *map(pa.array, np.ascontiguousarray(np.concatenate(sketches).T)),
            ],
            ["doc_id", "n", "digest", "shingle", *SKETCH],
        )
    if held:
        yield repeated()


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, by hash, and their counts: whole powers of two until the bound is met."""
    counts = staged(counts.groupBy("shingle").agg(F.sum("n").alias("n")).filter("n > 2"), "frequent")
    level = F.floor(F.log2("n")).cast("int").alias("level")
    least, total = 63, 0
    for row in sorted(counts.groupBy(level).count().collect(), reverse=True):
        total += row["count"]
        if total > MOST_FREQUENT:
            break
        least = row["level"]
    found = counts.filter(F.col("n") >= 2**least).toArrow() if least < 63 else None
    if found is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order]


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def needed(n: int, m: int) -> int:
    """The overlap from which sets of n and m elements link: 100 o >= 75 (n + m - o)."""
    return (3 * (n + m) + 6) // 7


def _indexer(frequent, class_at: int):
    def index(batches):
        hashes, counts = frequent.value
        seen: set[int] = set()
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        rows = 0

        def flushed():
            arrays = [pa.array(np.concatenate(c)) for c in columns]
            return pa.RecordBatch.from_arrays(arrays, ["shingle", "part", "class", "n", "place"])

        for batch in batches:
            for own in shingle_sets(batch.column("text").to_pylist()):
                name = _class(_digest(own), class_at)
                if not len(own) or name in seen:
                    continue
                seen.add(name)
                p = prefix_length(len(own))
                parts = np.zeros(p, np.int64)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                    often = hashes[at] == own
                    plain = own[~often]
                    if len(plain) >= p:
                        own_prefix = plain[:p]
                    else:
                        at = at[often]
                        at = at[np.lexsort((hashes[at], counts[at]))][: p - len(plain)]
                        own_prefix = np.concatenate([plain, hashes[at]])
                        parts[len(plain) :] = (name & 0x7FFFFFFF) % (counts[at] // LIST_LENGTH + 1) + (
                            counts[at] >= LIST_LENGTH
                        )
                else:
                    own_prefix = own[:p]
                for column, values in zip(
                    columns,
                    (
                        own_prefix.view(np.int64),
                        parts,
                        np.full(p, name, np.int64),
                        np.full(p, len(own), np.int64),
                        np.arange(p),
                    ),
                    strict=True,
                ):
                    column.append(values)
                rows += p
                if rows >= 200_000:
                    yield flushed()
                    columns, rows = [[], [], [], [], []], 0
        if rows:
            yield flushed()

    return index


def _may_link(n: int, i: int, m: int, j: int) -> bool:
    """Whether sets of n >= m elements that share what stands at places i and j can still link."""
    return 4 * m >= 3 * n and min(n - i, m - j) >= needed(n, m)


def _listed(batches):
    """Lists with several classes (kind 0), and the pairs of each run's smallest set (kind 1), of sorted entries."""
    names = ["kind", "shingle", "class", "n", "place"]
    carried: pa.RecordBatch | None = None

    def lists(table: pa.Table):
        shingle, part, own, n, place = (
            table.column(c).to_numpy() for c in ("shingle", "part", "class", "n", "place")
        )
        if not len(shingle):
            return
        new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (part[1:] != part[:-1])])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        # The same class comes from several tasks; entries are sorted, so its repeats are neighbours.
        fresh = new | np.concatenate([[True], own[1:] != own[:-1]])
        several = np.bincount(group, fresh, len(starts))[group] > 1
        keep = fresh & (several | (part > 0))
        shingle, own, n, place, group = shingle[keep], own[keep], n[keep], place[keep], group[keep]
        pairs = set()
        last, pivot = -1, 0
        sizes, places, of = n.tolist(), place.tolist(), group.tolist()
        for i in range(len(of)):
            if of[i] != last or 4 * sizes[pivot] < 3 * sizes[i]:
                last, pivot = of[i], i
            elif _may_link(sizes[i], places[i], sizes[pivot], places[pivot]):
                pairs.add((pivot, i))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(own), np.int32)), *map(pa.array, (shingle, own, n, place))], names
        )
        if pairs:
            a, b = np.array(sorted(pairs)).T
            both = np.unique(np.stack([np.minimum(own[a], own[b]), np.maximum(own[a], own[b])]), axis=1)
            none = np.zeros(both.shape[1], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(both.shape[1], np.int32)), *map(pa.array, (both[0], both[1], none, none))], names
            )

    for batch in batches:
        table = pa.Table.from_batches([batch] if carried is None else [carried, batch])
        if not table.num_rows:
            continue
        shingle, part = table.column("shingle").to_numpy(), table.column("part").to_numpy()
        open_from = int(np.argmax((shingle == shingle[-1]) & (part == part[-1])))
        yield from lists(table.slice(0, open_from))
        carried = table.slice(open_from).combine_chunks().to_batches()[0]
    if carried is not None:
        yield from lists(pa.Table.from_batches([carried]))


def _overlaps(batches):
    """a, b, n_a, n_b and the overlap of pairs of texts; rows of one text a come together."""
    last_text, last = None, None
    for batch in batches:
        theirs = shingle_sets(batch.column("text_b").to_pylist())
        rows = []
        for a, b, text, other in zip(
            batch.column("a").to_pylist(),
            batch.column("b").to_pylist(),
            batch.column("text_a").to_pylist(),
            theirs,
            strict=True,
        ):
            if last is None or text != last_text:
                last_text, last = text, next(shingle_sets([text]))
            shared = len(last) + len(other) - len(np.union1d(last, other))
            rows.append((a, b, len(last), len(other), shared))
        names = ["a", "b", "n_a", "n_b", "shared"]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _texts_of(docs: DataFrame, wanted: DataFrame, class_at: int) -> DataFrame:
    """class, text of one document of each class in ``wanted`` (class, doc_id)."""

    def checked(batches):
        for batch in batches:
            expected = batch.column("class").to_pylist()
            sets = shingle_sets(batch.column("text").to_pylist())
            keep = [_class(_digest(s), class_at) == e for s, e in zip(sets, expected, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    wanted = staged(wanted, "wanted").withColumnRenamed("doc_id", "of")
    if wanted.count() <= 10 * BROADCAST_ROWS:  # two numbers a row
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select("class", "text")
    return texts.mapInArrow(checked, texts.schema)


def _compared(docs: DataFrame, classes: DataFrame, pairs: DataFrame, class_at: int) -> DataFrame:
    """``pairs`` (a, b: classes) with n_a, n_b and the size of their intersection."""
    involved = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    texts = staged(
        _texts_of(docs, classes.select("class", "doc_id").join(involved, "class"), class_at).dropDuplicates(["class"]), "texts"
    )
    side = lambda x: texts.select(F.col("class").alias(x), F.col("text").alias(f"text_{x}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return staged(joined.mapInArrow(_overlaps, "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint"), "compared")


def _links(compared: DataFrame) -> DataFrame:
    return compared.filter("100 * shared >= 75 * (n_a + n_b - shared)").select("a", "b")


def _merged(links: DataFrame, known: DataFrame) -> DataFrame:
    """The components that ``links`` make of the ``known`` ones."""
    return components(links.union(known.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _open_entries(lists: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries, with components and sketches, of the lists that hold several components; ``parts`` cuts long lists."""
    of = small(known.select(F.col("node").alias("class"), "component"))
    entries = lists.join(of, "class", "left").withColumn("component", F.coalesce("component", "class"))
    open_lists = staged(
        entries.groupBy("shingle")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("entries"))
        .filter("least < most")
        .select("shingle", F.floor(F.col("entries") / LIST_LENGTH + 1).alias("parts")),
        "open-lists",
    )
    found = entries.join(open_lists, "shingle").join(classes.select("class", *SKETCH), "class")
    return staged(found.select("shingle", "class", "n", "place", "component", "parts", *SKETCH), "open-entries")


def _tree(n: np.ndarray, place: np.ndarray, component: np.ndarray, sketch: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places that join the components of a list by what may link, closest sketches first."""
    far, done = 1 << 20, 1 << 21
    distance, nearest = np.full(len(n), far), np.zeros(len(n), np.int64)
    pairs, last = [], 0
    for _ in range(len(n) - 1):
        both = n + n[last]
        differ = np.bitwise_count(sketch ^ sketch[last]).sum(axis=1, dtype=np.int64)
        can = (
            (4 * np.minimum(n, n[last]) >= 3 * np.maximum(n, n[last]))
            & (np.minimum(n - place, n[last] - place[last]) >= (3 * both + 6) // 7)
            & (differ <= both // 7)
        )
        differ[~can] = far
        differ[component == component[last]] = -1
        distance[last] = done
        closer = (differ < distance) & (distance < done)
        distance[closer], nearest[closer] = differ[closer], last
        last = int(np.argmin(distance))
        if 0 <= distance[last] < far:
            pairs.append((int(nearest[last]), last))
    return pairs


def _bridges(batches):
    """a, b: classes of the pairs of :func:`_tree` for every list, or part of one, of sorted entries."""
    carried: pa.RecordBatch | None = None

    def bridged(table: pa.Table):
        shingle, part, own, n, place, component = (
            table.column(c).to_numpy() for c in ("shingle", "part", "class", "n", "place", "component")
        )
        if not len(shingle):
            return
        sketch = np.stack([table.column(c).to_numpy() for c in SKETCH], axis=1).view(np.uint64)
        new = np.flatnonzero((shingle[1:] != shingle[:-1]) | (part[1:] != part[:-1])) + 1
        pairs = set()
        for start, end in zip([0, *new.tolist()], [*new.tolist(), len(own)], strict=True):
            at = slice(start, end)
            for i, j in _tree(n[at], place[at], component[at], sketch[at]):
                a, b = int(own[start + i]), int(own[start + j])
                pairs.add((min(a, b), max(a, b)))
        columns = zip(*pairs, strict=True) if pairs else [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch] if carried is None else [carried, batch])
        if not table.num_rows:
            continue
        shingle, part = table.column("shingle").to_numpy(), table.column("part").to_numpy()
        open_from = int(np.argmax((shingle == shingle[-1]) & (part == part[-1])))
        yield from bridged(table.slice(0, open_from))
        carried = table.slice(open_from).combine_chunks().to_batches()[0]
    if carried is not None:
        yield from bridged(pa.Table.from_batches([carried]))


def _bridging(entries: DataFrame, compared: DataFrame, turn: int) -> DataFrame:
    """Fewer pairs than entries, not yet compared, that join the components of each list if they link.

    Long lists are cut into parts in a way that changes with the turn.
    """
    part = F.pmod(F.xxhash64("class", F.lit(turn)), "parts").alias("part")
    dealt = entries.select("shingle", part, "class", "n", "place", "component", *SKETCH)
    ordered = dealt.repartition("shingle", "part").sortWithinPartitions("shingle", "part", "class")
    pairs = ordered.mapInArrow(_bridges, "a bigint, b bigint").distinct()
    return staged(pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti"), "bridges")


def _crossing(entries: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs of different components that share an indexed shingle and may still link, not yet compared."""
    x, y = entries.alias("x"), entries.alias("y")
    may_link = F.expr(
        "x.shingle = y.shingle AND x.component <> y.component AND (x.n > y.n OR x.n = y.n AND x.class > y.class)"
        " AND 4 * y.n >= 3 * x.n AND least(x.n - x.place, y.n - y.place) >= (3 * (x.n + y.n) + 6) div 7"
        f" AND {_differing('x', 'y')} <= (x.n + y.n) div 7"
    )
    pairs = x.join(y, may_link).select(
        F.least("x.class", "y.class").alias("a"),
        F.greatest("x.class", "y.class").alias("b"),
    )
    pairs = staged(pairs.distinct().join(compared.select("a", "b"), ["a", "b"], "left_anti"), "crossing")
    # |u & v| <= |u & p| + |v - p| for each p that both were compared with.
    seen = compared.select("a", "b", "n_a", "n_b", "shared")
    seen = staged(
        seen.select(F.col("a").alias("u"), F.col("n_a").alias("n"), F.col("b").alias("p"), "shared").union(
            seen.select("b", "n_b", "a", "shared")
        ),
        "answers",
    )
    of = lambda x, p: seen.select(
        F.col("u").alias(x), F.col("p").alias(p), F.col("n").alias(f"n_{x}"), F.col("shared").alias(f"shared_{x}")
    )
    bounded = (
        pairs.join(of("a", "p"), "a")
        .join(of("b", "p"), ["b", "p"])
        .filter(
            "least(shared_a + n_b - shared_b, shared_b + n_a - shared_a) < (3 * (n_a + n_b) + 6) div 7"
        )
        .select("a", "b")
        .distinct()
    )
    return staged(pairs.join(bounded, ["a", "b"], "left_anti"), "to-compare")


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    described = staged(
        docs.mapInArrow(
            _described,
            f"doc_id {doc_type}, n bigint, digest binary, shingle bigint, {', '.join(f'{s} bigint' for s in SKETCH)}",
        ),
        "described",
    )
    sets = described.filter("digest IS NOT NULL").select("doc_id", "n", "digest", *SKETCH)
    frequent = spark.sparkContext.broadcast(_frequent(described.filter("shingle IS NOT NULL").select("shingle", "n")))

    # A class is named by eight bytes of its digest: the first that no two digests share.
    for class_at in range(16 - CLASS_BYTES + 1):
        number = F.conv(F.hex(F.substring("digest", class_at + 1, CLASS_BYTES)), 16, -10).cast("long")
        named = sets.withColumn("class", number)
        clash = named.groupBy("class").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x <> y")
        if clash.isEmpty():
            break
    else:
        raise ValueError("digests share all their bytes")
    sets = named.drop("digest")
    classes = staged(
        sets.filter("n > 0")
        .groupBy("class")
        .agg(F.min("doc_id").alias("doc_id"), *(F.min(s).alias(s) for s in SKETCH)),
        "classes",
    )

    index = docs.mapInArrow(
        _indexer(frequent, class_at), "shingle bigint, part bigint, class bigint, n bigint, place bigint"
    )
    ordered = index.repartition("shingle", "part").sortWithinPartitions("shingle", "part", "n", "class")
    listed = staged(
        ordered.mapInArrow(_listed, "kind int, shingle bigint, class bigint, n bigint, place bigint"), "lists"
    )
    lists = listed.filter("kind = 0").select("shingle", "class", "n", "place")
    pairs = listed.filter("kind = 1").select(F.col("shingle").alias("a"), F.col("class").alias("b"))
    first = _compared(docs, classes, staged(pairs.distinct(), "pairs"), class_at)
    known = components(_links(first))
    entries = _open_entries(lists, known, classes)
    for turn in range(MOST_TURNS):
        pairs = _bridging(entries, first, turn)
        if pairs.isEmpty():
            break
        cut = not entries.filter("parts > 1").isEmpty()
        turned = _compared(docs, classes, pairs, class_at)
        links = _links(turned)
        first = first.union(turned)
        if links.isEmpty():
            break
        known = _merged(links, known)
        entries = _open_entries(entries.select("shingle", "class", "n", "place"), known, classes)
        if not cut:
            break
    second = _compared(docs, classes, _crossing(entries, first), class_at)
    found = _merged(_links(second), known)

    of_class = staged(
        classes.select("class", "doc_id").join(small(found.select(F.col("node").alias("class"), "component")), "class", "left").select(
            "class", F.coalesce("component", "class").alias("component"), "doc_id"
        ),
        "of-class",
    )
    least = staged(of_class.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    of_class = staged(of_class.join(least, "component").select("class", "component_id"), "component-ids")
    linked = sets.filter("n > 0").join(of_class, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.union(alone)
