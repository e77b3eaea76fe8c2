"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Texts are compared as lower-case words; two are near copies when their word edit
distance is at most (1 - `similarity`) of the longer one's words.

Sketches. A document's k-mers are its runs of five words, each labelled with its
occurrence number. Each of `sketches` hash orders picks the `DEPTH` smallest ones,
and the sketch is those k-mers *in text order*: equal sketches speak for shared
passages in the same order, that is, for a small edit distance. Texts of up to
`SHORT` words, whose runs of five an edit or two destroy, are also keyed by the
smallest of their runs of two words in each order.

Candidates. Equal texts are first taken together (one class each), so copies never
meet. In a bucket of equal sketches every class is compared with the bucket's least
id only: as many pairs as rows. A bucket of three or more in which a comparison
failed stays open: its members may be near each other, but the passage that brought
them together says nothing about it. So the k-mers that an open bucket's least id
shares with one that failed are set aside, and its members and the other texts of
which these make a good part (`HELD` of their `PROBES` smallest k-mers; where they make
less, the sketches see past them) are keyed again by what is left of them: the `REST` smallest k-mers, each a key of its own (all of them, where no more
are left). That goes on until no bucket is open. Every
round sets aside the keys of its open buckets, so it ends; and none compares more
pairs than it has rows.

Verification. Candidates whose bags of words already differ too much are settled
without alignment; the others run a bit-parallel edit distance within the band of
diagonals that the allowed distance leaves.

Groups. Links between classes are joined to connected components by contraction,
each round written to the shared folder.

Recall follows from the sketches: two texts that share the fraction j of their
labelled k-mers agree in one sketch of three with about j^3, so 32 sketches miss
j = 0.8 with 1e-10, 0.67 (0.8 of each text's five-word runs) with 1e-5, and 0.5
with 1 %. Beyond it are longer texts whose every run of five words is touched by an
edit, and texts of a cloud that are near each other only by what many share.

Defined cases: null, empty and word-less texts are copies of each other; a text of
fewer than five words has one k-mer; rows that share a doc_id count as one
document, for which its text of the least digest is compared; rows with a null
doc_id are left alone (own class, kept); an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import forget, materialize, salted_join
from tidepanel.llm.decontaminate import words_of
from tidepanel.session import bounded_broadcast

K = 5
DEPTH = 3
SKETCHES = 32
SHORT = 16               # words up to which runs of SHORT_K words are keys too
SHORT_K = 2
REST = 64                # keys of what is left of a member of an open bucket
PROBES = 32              # k-mers of a text that tell whether it holds many that are set aside
HELD = 4                 # so many of its probes, that is
SIMILARITY = 0.8
MOST_BROADCAST_IDS = 1_000_000
MOST_ASIDE = 1_000_000   # k-mers set aside that are sent to all tasks; more are joined
MIX = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 18          # hashes of a text held at once: a few arrays of 2 MB in a Python worker


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the runs of k words, each labelled with its occurrence number."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    k = min(k, n)
    out = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        out = mixed(out * MIX + words[i:n - k + 1 + i])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    same = ranked[1:] == ranked[:-1]
    if same.any():
        place = np.arange(len(out))
        first = np.maximum.accumulate(np.where(np.r_[True, ~same], place, 0))
        again = place > first
        out[order[again]] = mixed(ranked[again] + (place - first)[again].astype(np.uint64) * MIX)
    return out


def sketch_keys(h: np.ndarray, multipliers: np.ndarray, depth: int) -> np.ndarray:
    """One key a hash order, from the `depth` smallest of the k-mers `h` in text order."""
    if not len(h):
        return np.empty(0, dtype=np.int64)
    most = min(depth, len(h))
    found = []
    each = max(1, CELLS // len(h))  # hash orders at a time, for bounded memory
    for at in range(0, len(multipliers), each):
        m = multipliers[at:at + each, None]
        value = (h[None] ^ (m >> np.uint64(7))) * m
        if most < len(h):
            least = np.sort(np.argpartition(value, most - 1, axis=1)[:, :most], axis=1)
        else:
            least = np.broadcast_to(np.arange(len(h)), value.shape)
        in_order = h[least]
        key = mixed(m[:, 0])
        for i in range(in_order.shape[1]):
            key = mixed(key * MIX + in_order[:, i])
        found.append(key)
    return np.concatenate(found).view(np.int64)


def short_runs(words: np.ndarray) -> np.ndarray:
    return kmers(words, SHORT_K) if len(words) <= SHORT else np.empty(0, dtype=np.uint64)


def smallest(h: np.ndarray, n: int) -> np.ndarray:
    """The n smallest of the distinct k-mers `h` in one hash order, the same for all texts."""
    return (h[np.argpartition(mixed(h), n - 1)[:n]] if len(h) > n else h).view(np.int64)


def all_kmers(words: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([kmers(words), short_runs(words)]))


def left_of(words: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """Keys of a text without the (sorted) k-mers `aside`."""
    h = all_kmers(words)
    if len(aside):
        h = h[aside[np.minimum(np.searchsorted(aside, h), len(aside) - 1)] != h]
    return smallest(h, REST)


def banded_distance(a: list, b: list, most: int) -> int:
    """Edit distance of two sequences if it is at most `most`, else most + 1. Bits
    are the cells of one column within `most` diagonals of the main one."""
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > most:
        return most + 1
    most_here = min(most, m)
    if most_here < most or n == 0:  # the band covers everything: a wider one is exact
        return full_distance(a, b, most)
    width = 2 * most + 2
    full = (1 << width) - 1
    masks: dict = defaultdict(int)
    for i, x in enumerate(a):
        masks[x] |= 1 << i
    up, down = full ^ ((1 << (width - most - 1)) - 1), 0
    distance, diagonal = most, 1 << (width - 1)
    row, give_up = 1 << (width - 2), 2 * most + m - n
    shift = most + 1 - width
    for j, x in enumerate(b):
        same = masks.get(x, 0)
        same = (same >> shift if shift >= 0 else same << -shift) & full
        shift += 1
        d = ((((same & up) + up) ^ up) | same | down) & full
        plus = (down | ~(d | up)) & full
        minus = d & up
        if j < n - most:
            if not d & diagonal:
                distance += 1
        else:
            if plus & row:
                distance += 1
            elif minus & row:
                distance -= 1
            row >>= 1
        if distance > give_up:
            return most + 1
        half = d >> 1
        up, down = (minus | ~(half | plus)) & full, half & plus
    return distance if distance <= most else most + 1


def full_distance(a: list, b: list, most: int) -> int:
    """The same without a band, for texts not longer than the allowed distance."""
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        current = [i]
        for j, y in enumerate(b, 1):
            current.append(min(previous[j - 1] + (x != y), previous[j] + 1, current[-1] + 1))
        previous = current
    return min(previous[-1], most + 1)


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    most = int((1 - similarity) * longest + 1e-9)
    if longest - min(len(a), len(b)) > most:
        return False
    # words that the bags do not share each cost an edit
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if longest - int(np.minimum(nx[i], ny[j]).sum()) > most:
        return False
    return banded_distance(a.tolist(), b.tolist(), most) <= most


def list_slices(column: pa.ListArray) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[i:j] for i, j in zip(at, at[1:])]


def word_hashes() -> Column:
    """The words of a text as numbers; an empty array without words."""
    words = F.trim(words_of("text"))
    return F.when(words == "", F.array().cast("array<long>")).otherwise(
        F.transform(F.split(words, " "), lambda w: F.xxhash64(w)))


def text_digest() -> Column:
    return F.md5(words_of("text").cast("binary"))


def with_words(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"),
        word_hashes().alias("words"))


def per_text(rows: DataFrame, made: dict, extra: str = "") -> DataFrame:
    """doc_id, digest and a list column for every function of `made`, each of the words (and
    of the column `extra`) of a row."""
    def keyed(batches):
        for batch in batches:
            columns = [list_slices(batch.column(c)) for c in ["words", *extra.split()]]
            texts = [[x.view(np.uint64) for x in row] for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"),
                 *(pa.array([f(*row) for row in texts], pa.list_(pa.int64())) for f in made.values())],
                names=["doc_id", "digest", *made])

    return rows.mapInArrow(keyed, "doc_id long, digest string, " + ", ".join(
        f"{name} array<long>" for name in made))


def sketch_documents(docs: DataFrame, sketches: int, seed: int) -> DataFrame:
    """doc_id, digest of the words, keys, probes."""
    rng = np.random.default_rng(seed)
    multipliers = rng.integers(1, 2 ** 63, sketches, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys_of(words):
        return np.concatenate([sketch_keys(kmers(words), multipliers, DEPTH),
                               sketch_keys(short_runs(words), multipliers, 1)])

    return per_text(with_words(docs), {
        "keys": keys_of, "probes": lambda words: smallest(all_kmers(words), PROBES)})


def only(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of `docs` that are the text of a node (id, digest), one row each."""
    ids = nodes.select(F.col("id").alias("doc_id")).distinct()
    pairs = nodes.select(F.col("id").alias("doc_id"), "digest").distinct()
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(bounded_broadcast(ids, MOST_BROADCAST_IDS), "doc_id", "left_semi")
            .withColumn("digest", text_digest())
            .join(bounded_broadcast(pairs, MOST_BROADCAST_IDS), ["doc_id", "digest"], "left_semi")
            .groupBy("doc_id", "digest").agg(F.min("text").alias("text")))


def bodies_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc_id, digest, words of the nodes (id, digest), written once: a round reads the texts
    here, and `docs` is scanned once a round."""
    return materialize(only(docs, nodes).select("doc_id", "digest", word_hashes().alias("words")),
                       "bodies")


def are_aside(kmers_of: DataFrame, aside: DataFrame, salts: int = 16) -> DataFrame:
    """The rows of `kmers_of` (doc_id or id, kmer) whose k-mer is one of `aside`."""
    if aside.limit(MOST_ASIDE + 1).count() <= MOST_ASIDE:
        return kmers_of.join(F.broadcast(aside), "kmer", "left_semi")
    salt = F.pmod(F.xxhash64(kmers_of.columns[0]), F.lit(salts).cast("long")).cast("int")
    return kmers_of.withColumn("salt", salt).join(
        aside.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
        ["kmer", "salt"], "left_semi").drop("salt")


def holders_of(nodes: DataFrame, kmers_: DataFrame) -> DataFrame:
    """id of the `nodes` that have at least HELD of the k-mers `kmers_` (column kmer) among
    their probes. Counted inside the batches: a row per node, not one per probe."""
    if kmers_.limit(MOST_ASIDE + 1).count() <= MOST_ASIDE:
        known = np.sort(kmers_.toArrow().column("kmer").to_numpy())

        def counted(batches):
            for batch in batches:
                n = np.zeros(batch.num_rows, dtype=np.int64)
                probes = batch.column("probes")
                if len(known):
                    at = np.repeat(np.arange(len(n)), np.diff(probes.offsets.to_numpy()))
                    flat = probes.flatten().to_numpy(zero_copy_only=False)
                    hit = known[np.minimum(np.searchsorted(known, flat), len(known) - 1)] == flat
                    n += np.bincount(at[hit], minlength=len(n))
                some = pa.array(n > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").filter(some), pa.array(n).filter(some)], names=["id", "n"])

        counts = nodes.select("id", "probes").mapInArrow(counted, "id long, n long")
    else:
        counts = are_aside(nodes.select("id", F.explode("probes").alias("kmer")), kmers_).select(
            "id", F.lit(1).alias("n"))
    return counts.groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= HELD).select("id")


def keys_without(docs: DataFrame, aside: DataFrame) -> DataFrame:
    """doc_id, digest, keys of what is left of `docs` (of `only` or `bodies_of`) without the
    k-mers `aside`."""
    rows = docs
    if "words" not in docs.columns:
        rows = docs.select("doc_id", "digest", word_hashes().alias("words"))
    if aside.limit(MOST_ASIDE + 1).count() <= MOST_ASIDE:
        known = np.sort(aside.toArrow().column("kmer").to_numpy().view(np.uint64))
        return per_text(rows, {"keys": lambda words: left_of(words, known)})
    # too many for every task: each text is told which of its own k-mers are among them
    own = per_text(rows, {"keys": lambda words: all_kmers(words).view(np.int64)})
    own = (are_aside(own.select("doc_id", "digest", F.explode("keys").alias("kmer")), aside)
           .groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list("kmer")).alias("aside")))
    told = rows.join(own, ["doc_id", "digest"], "left").withColumn(
        "aside", F.coalesce("aside", F.array().cast("array<long>")))
    return per_text(told, {"keys": lambda words, known: left_of(words, np.sort(known))}, "aside")


def candidates(rows: DataFrame) -> DataFrame:
    """key, id, leader, rows: `rows` (id, key) of buckets that hold several ids, with the
    least id and the size of the bucket, without the least id itself."""
    buckets = (rows.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("rows"))
               .where("rows > 1"))
    return salted_join(rows, materialize(buckets, "buckets"), "key", "id", 2000, "rows").where(
        F.col("id") != F.col("leader"))


def on_pairs(pairs: DataFrame, bodies: DataFrame, column: str, kind: str, judge) -> DataFrame:
    """`pairs` (id, leader) with `judge(words of id, words of leader)` as `column`; `bodies`
    (of `bodies_of`) holds all their texts."""
    ids = pairs.select("id").union(pairs.select("leader")).distinct()
    bodies = bodies.select(F.col("doc_id").alias("id"), F.col("words").alias("body"))
    if ids.limit(MOST_BROADCAST_IDS + 1).count() <= MOST_BROADCAST_IDS:
        bodies = bodies.join(F.broadcast(ids), "id", "left_semi")
    counts = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("rows"))
    leaders = materialize(
        bodies.withColumnsRenamed({"id": "leader", "body": "other"}).join(counts, "leader"),
        "leaders")
    both = salted_join(pairs, leaders, "leader", "id", 500, "rows").join(bodies, "id")
    schema = pa.bool_() if kind == "boolean" else pa.list_(pa.int64())

    def judged(batches):
        for batch in batches:
            out = [judge(a, b) for a, b in
                   zip(list_slices(batch.column("body")), list_slices(batch.column("other")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("leader"), pa.array(out, schema)],
                names=["id", "leader", column])

    done = materialize(both.select("id", "leader", "body", "other").mapInArrow(
        judged, f"id long, leader long, {column} {kind}"), f"pairs-{column}")
    forget(leaders)
    return done


def shared_kmers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """K-mers that two texts have in common, the keys of their buckets among them."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    return np.concatenate([
        np.intersect1d(kmers(a), kmers(b)), np.intersect1d(short_runs(a), short_runs(b))
    ]).view(np.int64)


def links(docs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(id, leader) of near copies between classes."""
    play, tried, aside, bodies = nodes, None, None, None
    while True:
        found = materialize(
            candidates(play.select("id", F.explode("keys").alias("key"))), "candidates")
        pairs = found.select("id", "leader").distinct()
        if tried is not None:
            pairs = pairs.join(tried.select("id", "leader"), ["id", "leader"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if bodies is None:  # of the first round; the others bring theirs along
            ids = pairs.select("id").union(pairs.select("leader")).distinct()
            bodies = bodies_of(docs, nodes.select("id", "digest").join(ids, "id", "left_semi"))
        if tried is None or pairs.limit(1).count():
            new = on_pairs(pairs, bodies, "linked", "boolean",
                           lambda a, b: near(a, b, similarity))
            tried = new if tried is None else tried.unionAll(new)
        # open: buckets of three or more with a comparison that failed; one stands for all
        failed = tried.where(~F.col("linked")).select("id", "leader")
        open_ = materialize(
            found.where("rows > 2").join(failed, ["id", "leader"]).groupBy("key").agg(
                F.max("id").alias("id"), F.max("leader").alias("leader"),
                F.max("rows").alias("held")), "open")
        one_each = materialize(open_.select("id", "leader").distinct(), "open-pairs")
        if not one_each.limit(1).count():
            forget(bodies)
            return tried.where("linked").select("id", "leader")
        shared = on_pairs(one_each, bodies, "shared", "array<long>", shared_kmers)
        more = materialize(shared.select(F.explode("shared").alias("kmer")).distinct(), "more")
        before, aside = aside, materialize(
            (more if aside is None else more.unionAll(aside)).distinct(), "aside")
        members = salted_join(found.drop("rows", "leader"), open_.select("key", "held"), "key", "id",
                              2000, "held").select("id").union(open_.select("leader"))
        members = members.union(holders_of(nodes, more)).distinct()
        again = materialize(nodes.select("id", "digest").join(members, "id", "left_semi"), "again")
        over = play if play is not nodes else None
        forget(bodies)
        bodies = bodies_of(docs, again)
        play = materialize(keys_without(bodies, aside).withColumnRenamed("doc_id", "id"), "keys-left")
        forget(found, pairs, open_, one_each, shared, more, before, again, over)


def sized(facts: DataFrame, rows: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`facts` with the number of `rows` of each key, for `salted_join`."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("held"))
    return materialize(counts.join(facts, key, how), "facts")


def roots(tree: DataFrame) -> DataFrame:
    """`tree` (id, up), where up is at most id, with up at the root: pointer jumping."""
    while True:
        further = tree.select(F.col("id").alias("up"), F.col("up").alias("further"))
        targets = sized(further, tree, "up")
        if not targets.where(F.col("up") != F.col("further")).limit(1).count():
            return tree
        tree = materialize(salted_join(tree, targets, "up", "id", 2000, "held")
                           .select("id", F.col("further").alias("up")), "tree")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id reachable over the links.

    Every node hangs under its least neighbour if that is smaller; the trees are
    flattened, each becomes one node, and the links that remain between them go
    through the same again. Links shrink with every round.
    """
    def ordered(a, b):
        return materialize(pairs_of(a, b).where("a > b").distinct(), "edges")

    def pairs_of(a, b):
        return current.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))

    current = edges
    links_left = ordered("id", "leader")
    named = None
    while named is None or links_left.limit(1).count():
        ids = links_left.select(F.col("a").alias("id")).union(links_left.select("b")).distinct()
        up = links_left.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("up"))
        tree = roots(materialize(ids.join(up, "id", "left").select(
            "id", F.coalesce("up", "id").alias("up")), "tree"))
        if named is None:
            named = tree.select("id", F.col("up").alias("component"))
        else:
            moved = sized(tree.select(F.col("id").alias("component"), F.col("up").alias("further")),
                          named, "component", "left")
            named = materialize(
                salted_join(named, moved, "component", "id", 2000, "held").select(
                    "id", F.coalesce("further", "component").alias("component")), "named")
        current = links_left
        for end, other in (("a", "b"), ("b", "a")):
            facts = sized(tree.select(F.col("id").alias(end), "up"), current, end)
            current = salted_join(current, facts, end, other, 2000, "held").select(
                F.col("up").alias(end), other)
        links_left = ordered("a", "b")
    return named


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES,
                 seed: int = 11) -> DataFrame:
    """doc_id, class_id, class_size, kept: the class is named by its smallest doc_id,
    which is the document that stays."""
    sketched = materialize(sketch_documents(docs, sketches, seed), "sketches")
    classes = materialize(sketched.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    # rows that share a doc_id are one document: the least digest speaks for it
    chosen = classes.groupBy("id").agg(F.min("digest").alias("digest"))
    nodes = sketched.withColumnRenamed("doc_id", "id").join(chosen, ["id", "digest"])
    nodes = materialize(nodes, "nodes")
    groups = components(links(docs, nodes, similarity))
    forget(nodes)
    named = (classes.join(groups, "id", "left")
             .withColumn("class_id", F.coalesce("component", "id"))
             .select("digest", "class_id", "copies"))
    named = materialize(named, "named")
    sizes = named.groupBy("class_id").agg(F.sum("copies").alias("class_size"),
                                          F.count(F.lit(1)).alias("texts"))
    named = materialize(salted_join(named, materialize(sizes, "sizes"), "class_id", "digest", 2000,
                                    "texts").drop("texts"), "facts")
    rows = (salted_join(sketched.select("doc_id", "digest"), named, "digest", "doc_id", 2000,
                        "copies")
            .select("doc_id", "class_id", "class_size",
                    (F.col("doc_id") == F.col("class_id")).alias("kept")))
    alone = docs.where(F.col("doc_id").isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return rows.unionByName(alone)


def keep_one_each(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES,
                  seed: int = 11) -> DataFrame:
    """`docs` with its own columns, one document of every class of near copies."""
    classes = materialize(near_classes(docs, similarity, sketches, seed), "near-classes")
    dropped = classes.where(~F.col("kept")).select(F.col("doc_id").alias("_dropped"))
    dropped = bounded_broadcast(dropped, MOST_BROADCAST_IDS)
    rows = docs.select(F.struct(*docs.columns).alias("row"),
                       F.col("doc_id").cast("long").alias("_id"))
    return rows.join(dropped, F.col("_id") == F.col("_dropped"), "left_anti").select("row.*")
