"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles, held as 64-bit hashes. Equal sets form classes by a 128-bit digest of the set, and
only one document of a class goes on, so thousands of copies cost one comparison.

1. Grouping. Three keys of two min-hashes each place every class in up to three blocks of similar documents; a key with
   many documents is dealt over blocks of about `BLOCK`, so no family meets in one task. Inside a block, groups grow one
   document at a time. A group stores its token union; a document that shares fewer tokens with the union than a link
   needs cannot link to any member, and the group stays closed; otherwise members are compared until one links. Links
   join documents to components.
2. The matrix. If two sets link, their first n - ceil(t n) + LAP tokens, in one global order, share LAP tokens (or as
   many as the link needs, if fewer). Every document is at home in the largest block that holds it, or alone. Tokens of
   which all documents are linked already are settled; rows (token, block) of the others are the matrix. How many tokens
   two blocks share, their documents' sizes and the places of the tokens bound the overlap of any two of their documents.
3. Opening. Only qualifying pairs of blocks are opened: a block's members and the documents that ask for it meet in units
   of bounded size, the block's token union is asked first, and of every component one link is enough. Components are
   then contracted over the new links.

The global order puts frequent tokens last. Every task counts the tokens of its own documents and tells those that are
frequent there; the most frequent `HOT` of all become the end of the order. The order only moves work, never the result.

No key is left whole to one task. A token in very many documents is ranked in parts; a token in very many blocks has its
cells dealt by size, as linked documents are of nearly the same size, and then chunk against chunk. Keys of many documents,
blocks that many ask for and roots of large components are joined in parts. All of this moves work alone.

Defined cases: null and empty texts have no shingles and are linked with nothing; rows with a null doc_id have a null
component; rows that share a doc_id share a component; repeated rows each give a row; an empty table gives an empty result;
very long texts are one set of hashes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import EACH, Scratch, skewed_join, slices, table
from helixframe.llm.components import components

BLOCK = 64
UNIT = 128
LAP = 4
HOT = 1 << 18
#: Cells of a token: from CROWD on they are dealt by size and into chunks of CHUNK.
CROWD, CHUNK = 256, 2048
#: How many units' copies of one text a task makes.
TEXTS = 4096
KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Shingler:
    """Sorted distinct hashes of the k-word shingles of a text; fewer than k words are one shingle."""

    def __init__(self, k: int) -> None:
        self.k, self.known = k, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone, x20 and x09-x0D alone
        if not words:
            return np.zeros(0, np.int64)
        known = self.known
        if len(known) > 150_000:
            known.clear()
        ids = [known.get(w) for w in words]
        if None in ids:
            for at, w in enumerate(words):
                if ids[at] is None:
                    ids[at] = known[w] = xxhash.xxh64_intdigest(w)
        w = np.array(ids, np.uint64)
        k = min(self.k, len(w))
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                h = (h ^ w[j : j + n]) * M1
                h = (h ^ (h >> np.uint64(29))) * M2
            h ^= h >> np.uint64(32)
        h = h.view(np.int64)
        h.sort()
        return h[np.concatenate([[True], h[1:] != h[:-1]])]


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def group_block(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges (smallest node, node) of the groups inside one block."""
    groups: list[dict] = []
    for k in sorted(range(len(nodes)), key=lambda k: (len(sets[k]), nodes[k])):
        own, linked = sets[k], []
        need = -(-percent * len(own) // 100)
        for g in groups:
            if 100 * g["most"] < percent * len(own):
                continue  # every member is too small
            if len(g["members"]) > 2 and shared(own, g["union"]) < need:
                continue  # the bound: no member can share enough
            if any(links(sets[m], own, percent) for m in reversed(g["members"])):
                linked.append(g)
        new = {"members": [*(m for g in linked for m in g["members"]), k], "most": len(own)}
        new["union"] = np.unique(np.concatenate([own, *(g["union"] for g in linked)])) if linked else own
        groups = [g for g in groups if not any(g is x for x in linked)] + [new]
    out = []
    for g in groups:
        least = min(nodes[m] for m in g["members"])
        out += [(least, nodes[m]) for m in g["members"] if nodes[m] != least]
    return out


def summaries(docs: DataFrame, k: int, flush: int = 1_500_000) -> DataFrame:
    """Rows of documents (doc_id, n, digest) and, with a null digest, rows of tokens that are frequent in a task (doc_id
    is the token, n its documents there)."""
    names = ["doc_id", "n", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        held: list[np.ndarray] = []
        size = 0

        def frequent() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = np.flatnonzero(n >= max(3, len(held) // 4000))
            often = often[np.argsort(-n[often], kind="stable")[: HOT // 4]]
            return pa.RecordBatch.from_arrays([pa.array(values[often], pa.int64()), pa.array(n[often], pa.int64()), pa.nulls(len(often), pa.binary())], names=names)

        for b in slices(batches):
            sets = [shingle(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary())], names=names)
            seen = {id(s): s for s in sets if len(s)}
            held += seen.values()
            size += sum(map(len, seen.values()))
            if size > flush:
                yield frequent()
                held, size = [], 0
        if held:
            yield frequent()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, digest binary")


def prefixes(docs: DataFrame, k: int, percent: int, hot: np.ndarray) -> DataFrame:
    """doc_id, digest, n, prefix (tokens in the global order) and keys (min-hashes) of every document with shingles.
    `hot`: frequent tokens, rarest first."""
    by = np.argsort(hot)
    sent = docs.sparkSession.sparkContext.broadcast((hot[by], by + 1))  # HOT rows at most
    names, types = ["doc_id", "digest", "n", "prefix", "keys"], [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        values, ranks = sent.value
        seen: set[tuple[int, bytes]] = set()
        for b in slices(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingle(text)
                n, name = len(s), digest(s)
                if not n or (doc_id, name) in seen:  # a repeated row is one document
                    continue
                if len(seen) >= 10_000:
                    seen.clear()
                seen.add((doc_id, name))
                m = min(n, n - -(-percent * n // 100) + LAP)
                if len(values):
                    at = np.searchsorted(values, s)
                    at[at == len(values)] = 0
                    rank = np.where(values[at] == s, ranks[at], 0)
                    first = s[np.argsort(rank, kind="stable")[:m]] if rank.any() else s[:m]
                else:
                    first = s[:m]
                u = s.view(np.uint64)
                with np.errstate(over="ignore"):
                    least = [((u ^ np.uint64(c)) * M2).min() for c in KEYS]
                    keys = [int((least[j] * M1 ^ least[j + 1]).view(np.int64)) for j in range(0, len(KEYS), 2)]
                rows.append((doc_id, name, n, first, keys))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(run, "doc_id long, digest binary, n long, prefix array<long>, keys array<long>")


def edge_rows(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], pa.int64()) for j in (0, 1)], names=["a", "b"])


def block_edges(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges inside blocks. `members`: (block, node); a task streams through its blocks, one block in memory at a time."""
    rows = members.join(texts.hint("merge"), "node").repartition("block").sortWithinPartitions("block").select("block", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        now, nodes, sets, known = None, [], [], set()
        for b in slices(batches):
            for block, node, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != now:
                    if len(nodes) > 1:
                        yield edge_rows(group_block(nodes, sets, percent))
                    now, nodes, sets, known = block, [], [], set()
                own = shingle(text)
                if (node, digest(own)) not in known:
                    known.add((node, digest(own)))
                    nodes.append(node)
                    sets.append(own)
        if len(nodes) > 1:
            yield edge_rows(group_block(nodes, sets, percent))

    return rows.mapInArrow(run, "a long, b long")


def opened_edges(roles: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links of asking documents with blocks. `roles`: (unit, asks, node, grp); a unit holds a block's members, then those
    that ask for it, one at a time."""
    # a document that many units hold is joined with its text in parts, as every row takes the text along
    told = skewed_join(roles, texts.hint("merge"), ["node"], ["unit"], each=TEXTS)
    rows = told.repartition("unit").sortWithinPartitions("unit", "asks").select("unit", "asks", "node", "grp", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        now, members, union, known = None, [], None, set()
        for b in slices(batches):
            found = []
            for unit, asks, node, grp, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if unit != now:
                    now, members, union, known = unit, [], None, set()
                own = shingle(text)
                if not asks:
                    if (node, digest(own)) not in known:
                        known.add((node, digest(own)))
                        members.append((node, grp, own))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([m[2] for m in members])) if members else own[:0]
                if shared(own, union) < -(-percent * len(own) // 100):
                    continue  # the bound: no member can share enough
                settled = {grp}
                for other, other_grp, tokens in members:
                    if other_grp not in settled and links(own, tokens, percent):
                        settled.add(other_grp)
                        found.append((node, other))
            yield edge_rows(found)

    return rows.mapInArrow(run, "a long, b long")


def crowded_tokens(labelled: DataFrame, frequent: DataFrame, each: int) -> tuple[DataFrame, list[int]]:
    """`labelled` less the tokens of very many documents whose documents are all linked already, and the tokens of very
    many documents that are left. `frequent` (token, n) tells which to look at: at most the documents divided by `each`."""
    spark = labelled.sparkSession
    heavy = [r.token for r in frequent.where(F.col("n") > each).select("token").collect()]
    if not heavy:
        return labelled, []
    listed = F.broadcast(spark.createDataFrame([(t,) for t in heavy], "token long"))
    of_heavy = labelled.select("grp", F.explode("prefix").alias("token")).join(listed, "token", "left_semi")
    spread = {r.token: r.lo < r.hi for r in of_heavy.groupBy("token").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).collect()}
    settled = [t for t in heavy if not spread.get(t, False)]
    if settled:
        gone = spark.sparkContext.broadcast(np.array(settled, np.int64))
        schema = labelled.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = schema.names.index("places")
            for b in slices(batches):
                # a settled token keeps its place in the order but is no token of the matrix
                kept = [np.flatnonzero(~np.isin(p, gone.value)) for p in b.column(schema.names.index("prefix")).to_pylist()]
                cols = list(b.columns)
                cols[at] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

        labelled = labelled.mapInArrow(run, schema)
    return labelled, [t for t in heavy if spread.get(t, False)]


def shared_blocks(cells: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks (block_a < block_b) that share enough tokens for a link between two of their documents. `cells`
    (written): token, block, least and most size of its documents, rest, lo and hi of their groups."""
    n_cells = cells.groupBy("token").agg(F.count("*").alias("cells")).where("cells > 1")
    known = skewed_join(cells, n_cells, ["token"], ["block"])
    # two linked sizes differ by the factor 100 / percent at most, so by one band; the width leaves room for rounding
    width = float(np.log(100 / percent) * 1.001)
    band = lambda c: F.floor(F.log(F.col(c)) / F.lit(width)).cast("long") if percent < 100 else F.col(c)
    crowded = F.col("cells") > CROWD
    zero = F.array(F.lit(0).cast("long"))
    chunks = F.ceil(F.col("cells") / CHUNK).cast("long")
    named = lambda s: ["token", "cells", *(F.col(c).alias(f"{c}_{s}") for c in ("block", "least", "most", "rest", "lo", "hi"))]
    left = known.withColumn("band", F.explode(F.when(crowded, F.sequence(band("least"), band("most"))).otherwise(zero)))
    left = left.withColumn("chunk", F.pmod(F.xxhash64("block"), chunks)).select(*named("a"), "band", "chunk")
    right = known.withColumn("band", F.explode(F.when(crowded, F.sequence(band("least") - 1, band("most") + 1)).otherwise(zero)))
    right = right.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).select(*named("b"), "band", "chunk").drop("cells")
    need = f"cast(ceil({percent} * (least_a + least_b) / cast({100 + percent} as decimal(10,0))) as long)"
    fits = f"100 * most_a >= {percent} * least_b and 100 * most_b >= {percent} * least_a and least(rest_a, rest_b) - 1 >= {need} - {LAP}"
    first = F.when(crowded, F.greatest(band("least_a"), band("least_b") - 1)).otherwise(0)  # a pair counts in its first shared band
    pairs = left.join(right, ["token", "band", "chunk"]).where(f"block_a < block_b and {fits} and not (lo_a = hi_a and lo_b = hi_b and lo_a = lo_b)").where(F.col("band") == first)
    return pairs.groupBy("block_a", "block_b").agg(F.count("*").alias("both"), F.min(F.expr(need)).alias("need")).where(f"both >= least({LAP}, need)").select("block_a", "block_b")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, each: int = EACH) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: documents link when 100 * shared >= percent * union."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    told = scratch.written(summaries(docs, k), "sets")
    rows = told.where("digest is not null")
    frequent = told.where("digest is null").groupBy(F.col("doc_id").alias("token")).agg(F.sum("n").alias("n")).where("n >= 8")
    hot = np.array([r.token for r in frequent.orderBy(F.desc("n"), "token").limit(HOT).collect()][::-1], np.int64)
    classes = rows.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    every = prefixes(docs, k, percent, hot)
    reps = classes.select(F.col("rep").alias("node"), "digest")
    sets = scratch.written(every.withColumnRenamed("doc_id", "node").join(reps, ["node", "digest"], "left_semi").dropDuplicates(["node", "digest"]), "prefixes")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").where("node is not null")

    # 1: groups inside blocks
    keyed = sets.select("node", F.posexplode("keys").alias("which", "value")).select("node", F.xxhash64("which", "value").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    dealt = F.xxhash64("key", F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("size") / BLOCK).cast("long")))
    members = skewed_join(keyed, sizes, ["key"], ["node"], each=each).select(dealt.alias("block"), "node", "size").distinct()
    inner = scratch.written(block_edges(members.select("block", "node"), texts, k, percent), "edges")
    group = components(inner, scratch)

    # 2: the matrix of prefix tokens and blocks
    homes = members.groupBy("node").agg(F.max(F.struct("size", "block"))["block"].alias("home"))
    labelled = sets.join(group, "node", "left").join(homes, "node", "left").select("node", "n", "prefix", F.coalesce("component", "node").alias("grp"), F.coalesce("home", F.xxhash64("node", F.lit("alone"))).alias("block"), F.sequence(F.lit(0), F.size("prefix") - 1).alias("places"))
    labelled, heavy = crowded_tokens(labelled, frequent, each)
    matrix = labelled.select("node", "n", "grp", "block", F.explode("places").alias("place"), "prefix").select("node", "n", "grp", "block", "place", F.get("prefix", "place").alias("token"))
    if heavy:
        # their documents are not all linked: nothing of them is settled, and they need not be ranked together
        crowd = F.broadcast(spark.createDataFrame([(t, True) for t in heavy], "token long, heavy boolean"))
        matrix = matrix.join(crowd, "token", "left").withColumn("part", F.when(F.col("heavy"), F.col("block")).otherwise(F.lit(0).cast("long")))
        of_token = Window.partitionBy("token", "part")
        open_ = F.coalesce("heavy", F.lit(False)) | (F.col("lo") < F.col("hi"))
    else:
        of_token, open_ = Window.partitionBy("token"), F.col("lo") < F.col("hi")
    unsettled = matrix.withColumn("lo", F.min("grp").over(of_token)).withColumn("hi", F.max("grp").over(of_token)).where(open_)
    told_by = unsettled.groupBy("token", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("place")).alias("rest"), F.min("grp").alias("lo"), F.max("grp").alias("hi"))
    asked = scratch.written(shared_blocks(scratch.written(told_by, "matrix"), percent), "asked")

    # 3: documents ask for the blocks of others
    if asked.isEmpty():
        final = group
    else:
        at_home = labelled.select("node", "grp", "block")
        docs_in = at_home.groupBy(F.col("block").alias("block_a")).agg(F.count("*").alias("docs"))
        loads = skewed_join(asked, docs_in, ["block_a"], ["block_b"], each=each).groupBy("block_b").agg(F.ceil(F.sum("docs") / UNIT).cast("long").alias("parts"))
        unit = lambda part: F.xxhash64("block_b", part).alias("unit")
        loaded = skewed_join(asked, loads, ["block_b"], ["block_a"], each=each)
        by_home = skewed_join(loaded, at_home.withColumnsRenamed({"block": "block_a"}), ["block_a"], ["block_b"], each=each)
        asking = by_home.select(unit(F.pmod(F.xxhash64("node"), F.col("parts"))), F.lit(True).alias("asks"), "node", "grp")
        parts = loads.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        held = parts.join(at_home.withColumnsRenamed({"block": "block_b"}), "block_b").select(unit(F.col("part")), F.lit(False).alias("asks"), "node", "grp")
        final = components(inner.unionByName(opened_edges(asking.unionByName(held), texts, k, percent)), scratch)
    named = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    out = skewed_join(rows, named, ["digest"], ["doc_id"], "left", each=each).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
    return scratch.result(out)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


#: Words are runs of anything but x20 and x09-x0D; only A-Z are lowered. Links by shared shingles, components by reach.
OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS t FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON d.doc_id = r.x GROUP BY d.doc_id
"""
