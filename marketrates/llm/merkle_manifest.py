"""Merkle manifest of a dataset with checkpoint-and-recompute proofs (operator 13).

Every row is a leaf; the leaves of a group, in order, are the bottom of a tree in which two neighbours become one node, a last one alone becomes a node by itself, until one
is left; the groups' roots, in order, are the bottom of one more tree. Only every STEP-th level is written, each as a table of (tree, position, digest). A node of a written
level stands for an aligned subtree of 2**STEP nodes of the written level below: they are gathered by position, so a group never holds more than that, and no group
of rows is hot however large a tree is. A proof is made from the top down: a subtree's interior nodes are computed again from its written ones, each node's siblings are
taken, put before those that its subtree's own node has, and the interior is forgotten. The trees' heights follow from the numbers of leaves, which are counted, one row
a group.

A digest is lowercase hex SHA-256 of its inputs' texts, joined. A leaf's inputs are the columns, in the order given: `-` for null, otherwise the number of UTF-8 bytes, `:` and the
value. So texts of any length, null and empty ones have digests of their own. Null groups are a group, the first one; rows alike in group and order, repeated ones too, have
places next to each other, by their leaves' digests. An empty table has no rows and no root. Columns that are not named in the call take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinals
from .store import written

#: Levels between two written ones: 256 nodes below each.
STEP = 8
#: A step of a proof: the sibling, if there is one, and whether it stands to the left.
PATH = "array<struct<digest:string,before:boolean>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[str | Column]) -> Column:
    return digest(*[field(F.col(c) if isinstance(c, str) else c) for c in columns])


def _height(n: Column) -> Column:
    """Levels above n leaves until one node is left: the number of bits of n - 1."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))


def _above(nodes: Column) -> Column:
    """The level above: nodes two by two, a last one alone."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))))


def _interiors(level: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per aligned subtree of a written level: own = its nodes in order, with the carried columns; n0 .. nSTEP = the levels, while the tree has more above."""
    own = level.groupBy("tree", "height", F.shiftright("at", STEP).alias("up")).agg(F.sort_array(F.collect_list(F.struct("at", "digest", *carry))).alias("own"))
    own = own.withColumn("n0", F.col("own.digest"))
    for k in range(STEP):
        own = own.withColumn(f"n{k + 1}", F.when(F.col("height") > k, _above(F.col(f"n{k}"))).otherwise(F.col(f"n{k}")))
    return own


def written_levels(leaves: DataFrame) -> list[DataFrame]:
    """The written levels of all trees, lowest first: tree, at (place in the level, from 0), digest, height (levels of the tree above this one).

    leaves: the lowest, the same columns, as a table. The last level has the trees' single nodes only (height 0); trees that end sooner are carried up to it.
    """
    levels = [leaves]
    while (top := levels[-1].agg(F.max("height")).first()[0]) is not None and top > 0:
        nodes = _interiors(levels[-1]).select("tree", F.col("up").alias("at"), F.get(f"n{STEP}", F.lit(0)).alias("digest"), F.greatest(F.col("height") - STEP, F.lit(0)).alias("height"))
        levels.append(written(nodes, "level"))
    return levels


def proofs(levels: list[DataFrame], carry: tuple[str, ...] = ()) -> DataFrame:
    """tree, at, digest, the carried columns and path of each node of the lowest level: path has a step per level, from the bottom up to the tree's single node.

    A subtree's interior meets its own node's path in one row, so no path is shuffled but those of the written levels above the lowest.
    """
    known = levels[-1].select("tree", "at", "digest", *(carry if len(levels) == 1 else ()), F.array().cast(PATH).alias("path"))
    for n, level in reversed(list(enumerate(levels[:-1]))):
        own = ["at", "digest", *(carry if n == 0 else ())]
        sub = _interiors(level, tuple(own[2:])).join(known.select("tree", F.col("at").alias("up"), F.col("path").alias("rest")), ["tree", "up"])

        def path(i: Column) -> Column:
            steps = []
            for k in range(STEP):
                place = F.shiftright(i, k)
                sibling = F.get(F.col(f"n{k}"), place.bitwiseXOR(F.lit(1)))
                steps.append(F.struct(sibling.alias("digest"), (place.bitwiseAND(F.lit(1)) == 1).alias("before")))
            return F.slice(F.array(*steps), F.lit(1), F.least(F.col("height"), F.lit(STEP)))

        each = F.transform("own", lambda x, i: F.struct(*[x[c].alias(c) for c in own], F.concat(path(i), F.col("rest")).alias("path")))
        known = sub.select("tree", F.inline(each))
        if n:
            known = written(known, "proofs")
    return known


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def up(node: Column, step: Column) -> Column:
        sibling = F.coalesce(step["digest"], F.lit(""))
        return F.when(step["before"], digest(sibling, node)).otherwise(digest(node, sibling))

    return F.aggregate(path, start, up)


def manifest(rows: DataFrame, key: str, group: str, columns: list[str], tampered: Column | None = None) -> DataFrame:
    """key, leaf, subroot, root, path (from the leaf over the subroot to the root), tampered_leaf of each row.

    columns: what a leaf is made of; tampered: a leaf to be told beside the right one, null for none.
    """
    own = rows.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf(columns).alias("leaf"), (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered_leaf"))
    placed = written(with_ordinals(own, ["group"], [F.col("key").asc_nulls_first(), "leaf"], "at", 0), "leaves")
    groups = placed.groupBy("group").agg(F.count("*").alias("n"))
    groups = written(with_ordinals(groups, [], [F.col("group").asc_nulls_first()], "tree", 0).withColumn("height", _height(F.col("n"))), "groups")
    leaves = written(placed.join(groups, placed["group"].eqNullSafe(groups["group"])).select("tree", "at", "key", F.col("leaf").alias("digest"), "height", "tampered_leaf"), "leaves")
    levels = written_levels(leaves)
    subroots = levels[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), "digest")
    many = subroots.count()
    upper = written_levels(written(subroots.withColumn("height", F.lit(max(many - 1, 0).bit_length())), "subroots"))
    root = upper[-1].select(F.col("digest").alias("root"))  # one row
    tops = proofs(upper).select(F.col("at").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("top")).join(root)
    out = proofs(levels, ("key", "tampered_leaf")).join(written(tops, "tops"), "tree")
    return out.select("key", F.col("digest").alias("leaf"), "subroot", "root", F.concat("path", "top").alias("path"), "tampered_leaf")


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest_query(docs: DataFrame) -> DataFrame:
    """The contract's columns: a leaf per row of documents, trees by lang; of ids whose CRC-32 7 divides, n_chars is tampered with."""
    changed = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    other = leaf(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"])
    out = manifest(docs, "doc_id", "lang", COLUMNS, F.when(changed, other))
    out = out.withColumn("folded_root", fold(F.coalesce("tampered_leaf", "leaf"), F.col("path")))
    siblings = F.array_join(F.filter(F.col("path.digest"), lambda x: x.isNotNull()), "")
    return out.select(
        F.col("key").cast("long").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def oracle() -> str:
    """The result in SQL: levels made one after the other, every row walking up its own tree; CRC-32 bit by bit."""
    value = lambda x: f"coalesce(strlen(cast({x} AS VARCHAR)) || ':' || cast({x} AS VARCHAR), '-')"
    joined = lambda n: "sha256(" + " || ".join(value(n if c == "n_chars" else c) for c in COLUMNS) + ")"
    bits = "list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda p, q: xor(p >> 1, 3988292384::UBIGINT * (p & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(cast(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)), lambda a, x: {bits}), 4294967295::UBIGINT)"
    return f"""
        WITH RECURSIVE own AS (
          SELECT doc_id, lang, {joined('n_chars')} AS leaf, CASE WHEN {crc} % 7 = 0 AND n_chars IS NOT NULL THEN {joined('n_chars + 1')} ELSE {joined('n_chars')} END AS told FROM documents),
        placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM own),
        nodes AS (
          SELECT 0 AS level, tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
          UNION ALL SELECT level + 1, tree, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 2, n),
        subroots AS (SELECT tree, h AS subroot, level AS height FROM nodes WHERE n = 1),
        upper_nodes AS (
          SELECT 0 AS level, tree AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
          UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n),
        root AS (SELECT h AS root, level AS top FROM upper_nodes WHERE n = 1),
        every AS (
          SELECT tree, level, pos, h FROM nodes WHERE n > 1
          UNION ALL SELECT s.tree, s.height + u.level, u.pos, u.h FROM subroots s JOIN upper_nodes u ON u.n > 1),
        walk AS (
          SELECT tree, pos AS leaf_at, 0 AS level, told AS h, '' AS siblings FROM placed
          UNION ALL
          SELECT w.tree, w.leaf_at, w.level + 1, CASE WHEN w.place % 2 = 1 THEN sha256(x.h || w.h) ELSE sha256(w.h || coalesce(x.h, '')) END, w.siblings || coalesce(x.h, '')
          FROM (
            SELECT walk.*, CASE WHEN level < height THEN leaf_at >> level ELSE tree >> (level - height) END AS place
            FROM walk JOIN subroots USING (tree) JOIN root ON level < height + top) w
          LEFT JOIN every x ON x.level = w.level AND x.tree = w.tree AND x.pos = xor(w.place, 1))
        SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, w.h AS folded_root, w.h = root AS verified
        FROM placed p JOIN subroots s USING (tree) JOIN root ON true JOIN walk w ON w.tree = p.tree AND w.leaf_at = p.pos AND w.level = s.height + top"""
