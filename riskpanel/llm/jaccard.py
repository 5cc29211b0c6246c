"""Self-join of documents by the Jaccard similarity of their 5-word shingles.

Documents with the same set of shingles are one class. Links between classes are
found in four steps, none of which can lose one.

1. Screen. Of each set, the shingles whose hash is under a rate go to the hash's
   bucket; the rate depends on the set's size, and a set sends what any partner's
   rate asks for. A class stays if enough of its sent shingles are in other
   classes too: a partner lacks at most a quarter of them.
2. Shingle frequencies among the classes that stay. Shingles of one class alone count
   as missing in every partner; if these are over a quarter, the class has none.
3. Token-combination prefixes. The shared shingles in order of frequency, rare ones
   first, are cut to a prefix. Rare shingles are indexed alone. Frequent ones are
   dealt by hash into token classes and indexed as pairs within these. A token class
   with m shingles in the prefix survives m - k + 1 missing ones (k = 1 or 2), so
   the prefix is extended until the sum of these, its strength, exceeds what a partner
   may lack. Of two linked sets the smaller lacks a seventh at most, so every set has
   a short prefix as the smaller one and a longer one as the larger. The number of
   token classes follows the smaller set's size.
   A key also carries its room: if two sets share no earlier key, each has, before the
   shingle that completes this one, as many unshared shingles as the prefix has
   strength there, and they have no more in common than either has left. So keys
   whose sets are too long for their room are dropped before any pair is made: sets
   around a frequent passage meet only if the passage itself nearly links them.
4. Verification, in rounds. A round pairs every class with pivots of its index keys, so
   the work is linear in the index; pivots are sets with nearly nothing of their own, which
   link with whatever links in a group of near copies: in the first round the one that
   lacks least, later another one for each key. Links found join components, and keys
   whose holders are in one component are done with. After some rounds all pairs of a key
   are verified whose rooms, and whose numbers of shingles by frequency, allow a link.
   Bitmaps bound the overlap of a pair before its sets are compared.

Defined results: a null or empty text and one without words have no shingles, no
links and their own doc_id as component; a null doc_id never names a component
unless all its documents have none; repeated rows are linked like any others; an empty
table gives an empty result; other columns are kept by ``one_of_each`` and play no
part, whatever their names. Sets are told apart by 64-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm import texts

SHINGLE = 5
RARE = 16  # classes that hold a rare shingle, at most
PER_CLASS = 8  # shingles of a set for each of its token classes
BITS = 2048
OCTAVES = 12  # of the number of classes that hold a shingle; the last one has no end
DEALT = 4  # parts by hash of each octave
STAR_ROUNDS = 3
#: Roles of a set under a key: as the smaller one of a pair, and as the larger.
SMALLER, LARGER = 1, 2
SMALL = 1_000_000  # rows of a few bytes that may be broadcast


def rate(n: np.ndarray) -> np.ndarray:
    """The share of the hashes that a set of n shingles is screened by."""
    return np.where(n < 64, 1.0, np.where(n < 512, 0.5, 0.4))


def may_lack(n):
    """Shingles of a set of n that a linked set may lack: 100 * both >= 75 * either."""
    return n // 4


def linked(both, n, other):
    return 100 * both >= 75 * (n + other - both)


def sets_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents' distinct shingle hashes, sorted within a document, and their numbers."""
    data = texts.LOWER[data]
    words = texts.words_of(data, offsets)
    hashes = texts.word_hashes(data, words)
    document = words.document()
    at = texts.whole_windows(words, SHINGLE)
    keys, owner = [texts.window_hashes(hashes, SHINGLE)[at]], [document[at]]
    size = np.diff(words.first)
    for k in range(1, SHINGLE):  # a short text is one shingle
        short = np.flatnonzero(size == k)
        start = words.first[:-1][short]
        raw = sum((hashes[start + j] * texts.FACTORS[j] for j in range(k)),
                  np.zeros(len(short), np.uint64))
        keys.append(texts.mix(raw + np.uint64(k)))
        owner.append(short)
    keys, owner = np.concatenate(keys), np.concatenate(owner)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], np.bincount(owner[new], minlength=len(size))


def classes_of(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set."""
    ends = np.cumsum(n)
    raw = keys.tobytes()
    return np.array([xxhash.xxh3_64_intdigest(raw[8 * (e - k):8 * e])
                     for e, k in zip(ends.tolist(), n.tolist())], np.uint64).view(np.int64)


def _under(keys: np.ndarray, share: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(11)).astype(np.float64) < share * (1 << 53)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, class, set size and the screen hits that the class needs."""
    for rows, data, offsets in texts.parts(batches):
        keys, n = sets_of(data, offsets)
        owner = np.repeat(np.arange(len(n)), n)
        screened = np.bincount(owner[_under(keys, rate(n)[owner])], minlength=len(n))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(classes_of(keys, n)), pa.array(n, pa.int64()),
             pa.array(screened - may_lack(n), pa.int64())], names=["doc_id", "class", "n", "need"])


def _distinct_sets(data, offsets):
    """The sets of a part's distinct classes: keys, owner, class, size."""
    keys, n = sets_of(data, offsets)
    classes = classes_of(keys, n)
    _, one = np.unique(classes, return_index=True)
    one = one[n[one] > 0]
    place = np.full(len(n), -1)
    place[one] = np.arange(len(one))
    owner = place[np.repeat(np.arange(len(n)), n)]
    return keys[owner >= 0], owner[owner >= 0], classes[one], n[one]


def _packed(buckets: int, keys, owner, columns, extra=()) -> Iterator[tuple[int, bytes]]:
    """Per bucket of the keys one packed string: owners' columns, then their entries."""
    bucket = (keys >> np.uint64(8)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        own = order[cuts[b]:cuts[b + 1]]
        if len(own):
            who, at = np.unique(owner[own], return_inverse=True)
            yield b, texts.pack(*(c[who] for c in columns), at.astype(np.int32), keys[own],
                                *(x[own] for x in extra))


def _runs(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in found], pa.int32()),
         texts.binary_array([x for _, x in found])], names=["bucket", "runs"])


def _screen(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in texts.parts(batches):
            keys, owner, classes, n = _distinct_sets(data, offsets)
            sent = _under(keys, rate(-(-3 * n // 4))[owner])
            keys, owner = keys[sent], owner[sent]
            own = _under(keys, rate(n)[owner])
            yield _runs(list(_packed(buckets, keys, owner, [classes], [own])))
    return run


def _entries(table: pa.Table, columns: int, *kinds) -> list[np.ndarray]:
    """A bucket's entries: their owners' columns, the keys and further columns."""
    out = []
    for blob in table.column("runs").to_pylist():
        got = texts.unpack(blob, *[np.int64] * columns, np.int32, np.uint64, *kinds)
        out.append([*(c[got[columns]] for c in got[:columns]), *got[columns + 1:]])
    return [np.concatenate(c) for c in zip(*out)]


def _dealt(parts: int, classes: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """The rows packed by class into at most ``parts`` strings: as many rows as parts,
    however many classes there are."""
    part = (texts.mix(classes.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    full = np.flatnonzero(np.diff(cuts))
    blobs = [texts.pack(*(c[order[cuts[p]:cuts[p + 1]]] for c in (classes, *columns)))
             for p in full]
    return pa.table({"bucket": pa.array(full, pa.int32()), "runs": texts.binary_array(blobs)})


def _gathered(table: pa.Table, *kinds) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*(
        texts.unpack(blob, np.int64, *kinds) for blob in table.column("runs").to_pylist()))]


def _hits(parts: int):
    """Per class, its screened shingles in a bucket that another class has too."""
    def run(table: pa.Table) -> pa.Table:
        return _dealt(parts, *_hits_of(*_entries(table, 1, np.bool_)))
    return run


def _summed(table: pa.Table) -> pa.Table:
    classes, hits = _gathered(table, np.int64)
    who, at = np.unique(classes, return_inverse=True)
    return pa.table({"class": pa.array(who, pa.int64()),
                     "hits": pa.array(np.bincount(at, hits).astype(np.int64))})


def _hits_of(classes: np.ndarray, keys: np.ndarray, own: np.ndarray):
    order = np.lexsort((classes, keys))
    classes, keys, own = classes[order], keys[order], own[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
    classes, keys, own = classes[new], keys[new], own[new]
    same = keys[1:] == keys[:-1]
    shared = np.zeros(len(keys), bool)
    shared[1:] |= same
    shared[:-1] |= same
    return np.unique(classes[shared & own], return_counts=True)


def _tokens(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in texts.parts(batches):
            keys, owner, classes, n = _distinct_sets(data, offsets)
            yield _runs(list(_packed(buckets, keys, owner, [classes, n])))
    return run


def _shared(parts: int):
    """Per class, its shingles in a bucket that other classes hold, and how many do."""
    def run(table: pa.Table) -> pa.Table:
        classes, n, keys = _entries(table, 2)
        order = np.lexsort((keys, classes))
        classes, n, keys = classes[order], n[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
        classes, n, keys = classes[new], n[new], keys[new]
        _, at, count = np.unique(keys, return_inverse=True, return_counts=True)
        held = count[at].astype(np.int32)
        kept = held > 1
        return _dealt(parts, classes[kept], n[kept], keys[kept], held[kept])
    return run


# -- signatures -----------------------------------------------------------------------


def token_classes(n: int) -> int:
    """Into how many token classes the frequent shingles are dealt where the smaller set has n."""
    return 1 << max(0, (n // PER_CLASS).bit_length() - 1)


def least_overlap(n: int, other: int) -> int:
    """What linked sets of these sizes have in common at least: 3/7 of their sum."""
    return -(-3 * (n + other) // 7)


def roles(n: int) -> list[tuple[int, int, int]]:
    """(role, least overlap, token classes) of a set of n: as the smaller set, and as the
    larger one for each number of token classes that a smaller partner may have."""
    out = [(SMALLER, least_overlap(n, n), token_classes(n))]
    low = -(-3 * n // 4)
    for deal in sorted({token_classes(low), token_classes(n)}):
        out.append((LARGER, least_overlap(n, max(low, PER_CLASS * deal if deal > 1 else 1)), deal))
    return out


def pairs_within(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (earlier, later) of all pairs of equal numbers in ``group`` (-1: of none)."""
    order = np.argsort(group, kind="stable")
    order = order[group[order] >= 0]
    sorted_ = group[order]
    first = np.searchsorted(sorted_, sorted_, "left")
    rank = np.arange(len(order)) - first
    later = np.repeat(np.arange(len(order)), rank)
    earlier = first[later] + np.arange(len(later)) - np.repeat(np.cumsum(rank) - rank, rank)
    return order[earlier], order[later]


def prefix_keys(n: int, keys: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, ...]:
    """Index keys, rooms and roles of a set: n shingles, of which ``keys`` are shared by
    ``held`` classes."""
    order = np.lexsort((keys, held))
    keys, held = keys[order], held[order]
    m = len(keys)
    frequent = held > RARE
    out = []
    for role, least, deal in roles(n):
        if m < least:
            continue
        group = np.where(frequent, (texts.mix(keys) % np.uint64(deal)).astype(np.int64), -1)
        # what each shingle adds to the prefix's strength: the first of a pair class nothing
        adds = np.ones(m, np.int64)
        _, first = np.unique(group, return_index=True)
        adds[first[group[first] >= 0]] = 0
        strength = np.cumsum(adds)
        size = int(np.searchsorted(strength, m - least + 1)) + 1
        room = m - (strength - adds)
        head, group = keys[:size], group[:size]
        alone = np.flatnonzero(group < 0)
        i, j = pairs_within(group)
        low, high = np.minimum(head[i], head[j]), np.maximum(head[i], head[j])
        out.append((texts.mix(head[alone] + np.uint64(1)), room[alone], role))
        out.append((texts.mix(low * texts.FACTORS[0] + high * texts.FACTORS[1] + np.uint64(deal)),
                    room[j], role))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, at = np.unique(np.concatenate([k for k, _, _ in out]), return_inverse=True)
    rooms, bits = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    np.maximum.at(rooms, at, np.concatenate([r for _, r, _ in out]))
    np.bitwise_or.at(bits, at, np.concatenate([np.full(len(k), b) for k, _, b in out]))
    return found, rooms, bits


def by_octave(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """How many shingles are held by 1, 2 to 3, 4 to 7, ... classes, by parts of the hash."""
    octave = np.minimum(np.frexp(held)[1] - 1, OCTAVES - 1)
    part = ((keys >> np.uint64(40)) % np.uint64(DEALT)).astype(np.int64)
    return np.bincount(octave * DEALT + part, minlength=OCTAVES * DEALT).astype(np.int32)


def _sets(table: pa.Table) -> pa.Table:
    """Classes that may have a partner, with their shared shingles, a bitmap and index keys."""
    classes, sizes, keys, held = _gathered(table, np.int64, np.uint64, np.int32)
    order = np.lexsort((keys, classes))
    classes, sizes, keys, held = classes[order], sizes[order], keys[order], held[order]
    cuts = np.append(np.flatnonzero(np.append(True, classes[1:] != classes[:-1])), len(classes))
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        n, own = int(sizes[a]), keys[a:b]
        if n - len(own) > may_lack(n):
            continue
        bits = np.zeros(BITS, np.uint8)
        bits[(own >> np.uint64(20)) % np.uint64(BITS)] = 1
        index, rooms, role = prefix_keys(n, own, held[a:b])
        out.append((int(classes[a]), n, b - a, own.tobytes(), np.packbits(bits).tobytes(),
                    index.view(np.int64), rooms.astype(np.int32), role.astype(np.int32),
                    by_octave(own, held[a:b])))
    c, n, m, keys, bits, index, rooms, role, octaves = zip(*out) if out else [()] * 9
    return pa.table({"class": pa.array(c, pa.int64()), "n": pa.array(n, pa.int64()),
                     "m": pa.array(m, pa.int64()), "keys": pa.array(keys, pa.binary()),
                     "bits": pa.array(bits, pa.binary()),
                     "key": pa.array(index, pa.list_(pa.int64())),
                     "room": pa.array(rooms, pa.list_(pa.int32())),
                     "role": pa.array(role, pa.list_(pa.int32())),
                     "octaves": pa.array(octaves, pa.list_(pa.int32()))})


SET_FIELDS = ("class bigint, n bigint, m bigint, keys binary, bits binary, key array<bigint>, "
              "room array<int>, role array<int>, octaves array<int>")


# -- verification ---------------------------------------------------------------------


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps do not rule a link out."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
                .reshape(-1, BITS // 8) for c in ("bits_a", "bits_b"))
        n = {c: np.asarray(batch.column(c)) for c in ("n_a", "m_a", "n_b", "m_b")}
        only_a = np.bitwise_count(a & ~b).sum(1, dtype=np.int64)
        only_b = np.bitwise_count(b & ~a).sum(1, dtype=np.int64)
        most = np.minimum(n["m_a"] - only_a, n["m_b"] - only_b)
        good = linked(most, n["n_a"], n["n_b"])
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for n, other, x, y in zip(*(batch.column(c).to_pylist()
                                    for c in ("n_a", "n_b", "keys_a", "keys_b"))):
            both = np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64),
                                  assume_unique=True)
            good.append(linked(len(both), n, other))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame, bitmaps: bool) -> DataFrame:
    """The pairs (a, b) of classes that are linked; ``bitmaps`` rule most others out first."""
    def both(table: DataFrame, *columns: str) -> DataFrame:
        for end in ("a", "b"):
            table = table.join(sets.select(F.col("class").alias(end), *(
                F.col(c).alias(f"{c}_{end}") for c in columns)), end)
        return table

    if bitmaps:
        pairs = texts.stored(both(pairs, "n", "m", "bits").mapInArrow(
            _possible, "a bigint, b bigint"))
    return texts.stored(both(pairs, "n", "keys").mapInArrow(_linked, "a bigint, b bigint"))


def _small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if it has few rows (of a few numbers each)."""
    return F.broadcast(table) if table.count() <= SMALL else table


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of classes after their links: the smallest of a component.

    Labels are hooked onto the smallest neighbour and paths are cut short, until no
    link is between two labels.
    """
    while True:
        one, two = labels.toDF("a", "x"), labels.toDF("b", "y")
        between = texts.stored(links.join(_small(one), "a").join(_small(two), "b")
                               .where("x <> y").select("x", "y").distinct())
        if between.isEmpty():
            return labels
        both = between.unionByName(between.select(F.col("y").alias("x"), F.col("x").alias("y")))
        up = texts.stored(both.groupBy("x").agg(F.min("y").alias("y"))
                          .select("x", F.least("x", "y").alias("y")))
        few = up.count() <= SMALL
        for _ in range(2):
            again = up.toDF("y", "z")
            up = up.join(F.broadcast(again) if few else again, "y", "left").select(
                "x", F.coalesce("z", "y").alias("y"))
        up = up.toDF("label", "above")
        labels = texts.stored(labels.join(F.broadcast(up) if few else up, "label", "left").select(
            "class", F.coalesce("above", "label").alias("label")))


def index_of(sets: DataFrame) -> DataFrame:
    """Rows (class, n, m, key, room, role, most) of all index keys; ``most`` is the size of the
    largest partner that the room allows."""
    return sets.select("class", "n", "m", F.inline(F.arrays_zip("key", "room", "role"))).select(
        "*", F.expr("int(7 * room div 3 - n)").alias("most"))


def _active(rows: DataFrame, star: int) -> DataFrame:
    """The rows (with ``label``) under keys that more than one component holds, with the
    key's pivot; rows whose room fits no partner under the key go."""
    smaller, larger = F.col("role").bitwiseAND(SMALLER) > 0, F.col("role").bitwiseAND(LARGER) > 0
    # Sets with little of their own come first. Of these the first round takes those that lack
    # least, which is the text that a group of near copies comes from if the group has it; the
    # later ones another set for each key.
    lacks = F.col("n") - F.col("m") if star == 0 else F.lit(0)
    order = F.struct((F.lit(16) * (F.col("n") - F.col("room")) / F.col("n")).cast("int").alias("own"),
                     (lacks / F.col("n")).alias("lacks"),
                     F.xxhash64("class", *(["key"] if star else []), F.lit(star)).alias("o"),
                     "class", "label")
    keys = texts.stored(rows.groupBy("key").agg(
        F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.min(F.when(smaller, F.col("n"))).alias("least_n"),
        F.max(F.when(larger, F.col("n"))).alias("most_n"),
        F.max(F.when(larger, F.col("most"))).alias("reach"), F.min(order).alias("pivot"))
        .where("low <> high AND least_n <= most_n AND least_n <= reach"))
    total = keys.agg(F.sum("held")).first()[0] or 0
    # at most four keys for each shuffle partition have that many rows
    often = total // (4 * texts.partitions(rows.sparkSession))
    keys = keys.drop("low", "high")
    hot = F.broadcast(keys.where(F.col("held") > often))
    met = rows.join(hot, "key").unionByName(
        rows.join(hot, "key", "left_anti").join(keys.where(F.col("held") <= often), "key"))
    fits = ((larger & (F.col("least_n") <= F.least("n", "most")))
            | (smaller & (F.col("n") <= F.least("most_n", "reach"))))
    return texts.stored(met.where(fits).select(
        "class", "n", "m", "key", "room", "role", "most", "label", "pivot"))


def components(sets: DataFrame, index: DataFrame) -> DataFrame:
    """class and label of every class in ``sets``; linked classes have one label."""
    labels = sets.select("class", F.col("class").alias("label"))
    rows = index.withColumn("label", F.col("class"))
    tested = None
    for star in range(STAR_ROUNDS + 1):
        active = _active(rows, star)
        if active.isEmpty():
            break
        last = star == STAR_ROUNDS
        if last:
            pairs = _all_pairs(active.join(sets.select("class", "octaves"), "class"))
        else:
            # every holder with its keys' pivots: a pair for each row of the index at most,
            # in the first round for each class
            pairs = active.where(F.col("label") != F.col("pivot.label"))
            if star == 0:
                pairs = pairs.groupBy("class").agg(F.min("pivot").alias("pivot"))
            pairs = pairs.select("class", F.col("pivot.class").alias("other"))
        pairs = pairs.select(F.least("class", "other").alias("a"),
                             F.greatest("class", "other").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(_small(tested), ["a", "b"], "left_anti")
        pairs = texts.stored(pairs)
        labels = joined(labels, verified(pairs, sets, star > 0))
        tested = pairs if tested is None else tested.unionByName(pairs)
        rows = active.drop("label", "pivot").join(_small(labels), "class")
    return labels


def _all_pairs(active: DataFrame) -> DataFrame:
    """Pairs (class, other) of different components that a key's rooms allow to be linked.

    Two sets have, by each part of each octave, no more in common than either has there. So a
    set that lacks too much of what a whole group holds, and has rarer shingles instead, is
    not paired with that group.
    """
    one = active.where(F.col("role").bitwiseAND(SMALLER) > 0).select(
        "key", "class", "n", "room", "most", "label", "octaves")
    two = active.where(F.col("role").bitwiseAND(LARGER) > 0).select(
        "key", F.col("class").alias("other"), F.col("n").alias("size"),
        F.col("room").alias("space"), F.col("most").alias("limit"), F.col("label").alias("to"),
        F.col("octaves").alias("others"))
    both = " + ".join(f"least(octaves[{i}], others[{i}])" for i in range(OCTAVES * DEALT))
    return one.join(two, "key").where(
        "label <> to AND n <= size AND size <= most AND n <= limit "
        f"AND 7 * ({both}) >= 3 * (n + size)").select("class", "other")


# -- the join --------------------------------------------------------------------------


def grouped(documents: DataFrame) -> DataFrame:
    """doc_id, class, n_shingles and component_id of every document (stored)."""
    spark = documents.sparkSession
    texts.workers_find_package(spark)
    buckets = texts.partitions(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text")
    found = texts.stored(rows.mapInArrow(
        _classes, f"doc_id {kind}, class bigint, n bigint, need bigint"))
    hits = (rows.mapInArrow(_screen(buckets), "bucket int, runs binary")
            .groupBy("bucket").applyInArrow(_hits(buckets), "bucket int, runs binary")
            .groupBy("bucket").applyInArrow(_summed, "class bigint, hits bigint"))
    heads = (found.where("n > 0").groupBy("class")
             .agg(F.min("doc_id").alias("head"), F.first("need").alias("need")))
    stay = _small(texts.stored(
        heads.join(hits, "class", "left").where("need <= coalesce(hits, 0)").select("head")
        .distinct()))
    sets = texts.stored(
        rows.join(stay, rows["doc_id"].eqNullSafe(stay["head"]), "left_semi")
        .mapInArrow(_tokens(buckets), "bucket int, runs binary")
        .groupBy("bucket").applyInArrow(_shared(buckets), "bucket int, runs binary")
        .groupBy("bucket").applyInArrow(_sets, SET_FIELDS))
    labels = components(sets.drop("key", "room", "role"), index_of(sets))
    named = texts.stored(
        found.join(_small(labels), "class", "left")
        .select("doc_id", "class", "n", F.coalesce("label", "class").alias("label")))
    least = texts.stored(named.where("n > 0").groupBy(F.col("label").alias("of"))
                         .agg(F.min("doc_id").alias("least")))
    return named.join(least, (named["label"] == least["of"]) & (named["n"] > 0), "left").select(
        "doc_id", "class", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return grouped(documents).drop("class")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each component, with all its columns.

    Rows that repeat a doc_id with the same shingles count as one document.
    """
    kept = texts.stored(grouped(documents).where(
        "doc_id <=> component_id").groupBy("doc_id", "class").agg(F.count("*").alias("rows")))
    name = {c: texts.fresh(c, documents.columns) for c in ("__doc", "__class", "__rows", "__own")}
    kept = kept.toDF(name["__doc"], name["__class"], name["__rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in texts.parts(batches):
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(classes_of(*sets_of(data, offsets)))],
                names=[*rows.schema.names, name["__own"]])

    own = documents.mapInArrow(run, texts.with_fields(documents.schema,
                                                      (name["__own"], "bigint")))
    same = (own["doc_id"].eqNullSafe(kept[name["__doc"]])
            & (own[name["__own"]] == kept[name["__class"]]))
    repeated = kept.where(F.col(name["__rows"]) > 1)
    columns = [F.col(f"`{c}`") for c in documents.columns]
    out = own.join(kept, same, "left_semi")
    if not repeated.isEmpty():
        once = out.join(repeated, same, "left_semi").dropDuplicates(["doc_id", name["__own"]])
        out = out.join(repeated, same, "left_anti").unionByName(once)
    return out.select(*columns)


def report_sql() -> str:
    """DuckDB SQL for ``report``; pairs by shared shingles, components by recursion."""
    return rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(list_slice(ws, i, i + {SHINGLE - 1}), ' ') AS k FROM (
    SELECT r, ws, unnest(generate_series(1, greatest(len(ws) - {SHINGLE - 1}, 1))) AS i
    FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
b AS (
  SELECT x.r AS a, y.r AS b, count(*) AS m FROM s x JOIN s y ON x.k = y.k AND x.r < y.r
  GROUP BY ALL),
e AS (
  SELECT a, b FROM b JOIN n p ON p.r = a JOIN n q ON q.r = b
  WHERE 100 * m >= 75 * (p.n + q.n - m)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (
  SELECT r AS a, r AS b FROM d UNION SELECT reach.a, w.b FROM reach JOIN both_ways w ON reach.b = w.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d t ON t.r = reach.b
GROUP BY d.r, d.doc_id, n.n
"""
