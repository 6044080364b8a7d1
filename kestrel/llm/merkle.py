"""Merkle manifest of a dataset (operator 12).

A leaf is the SHA-256 of a document's fields, each as ``-`` (null) or byte
count, ``:``, value; digests are passed on as lowercase hex. The leaves of a
source stand in ascending doc_id order; while several nodes remain, every
``ARITY`` consecutive ones (the last run may be shorter, even one) become the
hash of their digests. The subroots of the sources, in order of source (null
first, then by UTF-8 bytes), are joined to the root in the same way.

Tree levels are lag/lead windows. Nodes are dealt to blocks of ``ARITY ** DEEP``
consecutive places of a source (of all subroots, for the upper tree), so a hot
source is as many window groups as it has blocks, and no window is longer than
a block. Within a block, level after level: the siblings of the node that
starts at place p stand at the fixed offsets ``ARITY ** level``, times 1, 2 ..
rows before and after it; lag and lead columns fetch them, masked by the
node's slot in its run and the run's length, and the first child's row hashes
its own and its siblings' digests to the parent. All levels of a block share
one shuffle and one sort. The block tops are the nodes of the next tier, which
is ``ARITY ** DEEP`` times smaller, until every source has one node.

On the way down a running window hands each leaf the siblings that the first
rows of its ancestors fetched, and a join by block adds those of the tiers
above. So a leaf row holds the siblings of all its levels: the proof, whose
hash is reported, and with which a tampered leaf is folded up again.

Places come from range partitions of (source, doc_id, leaf), see
``kestrel.operators.positions``; only digests are shuffled, never texts.

Defined results
    null in any field     ``-``; a null doc_id comes first in its source and is
                          never tampered with; null source is a source
    repeated doc_id       ordered by leaf digest; equal rows are equal leaves
                          with proofs of their own
    empty, very long text hashed whole, whatever its length
    one document          leaf = subroot = root; proof is the hash of nothing
    empty table           empty result
    extra columns         ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.positions import with_group_positions
from kestrel.session import discard, materialize

ARITY = 3
DEEP = 6  # levels of one block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """Leaf of a document whose text is ``text``."""
    return sha(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]))


def tampered_text(text: Column) -> Column:
    """The text that tampering leaves: without its line ends."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


# --- one tier ------------------------------------------------------------------

ORDER = "over (partition by tree, block order by place)"


def _siblings(level: int) -> tuple[str, str]:
    """Left and right siblings of the node that starts on a row at a level,
    joined, as SQL text; null on all other rows and once the tree has one node."""
    step = ARITY ** level
    number, nodes = f"(place div {step})", f"((nodes + {step - 1}) div {step})"
    slot = f"({number} % {ARITY})"
    run = f"least({ARITY}, {nodes} - {number} + {slot})"
    left = [f"case when {slot} >= {k} then lag(node, {k * step}) {ORDER} else '' end" for k in range(ARITY - 1, 0, -1)]
    right = [f"case when {slot} + {k} < {run} then lead(node, {k * step}) {ORDER} else '' end" for k in range(1, ARITY)]
    starts = f"place % {step} = 0 and {nodes} > 1"
    return tuple(f"case when {starts} then concat({', '.join(side)}) end" for side in (left, right))


def _climb(nodes: DataFrame, keep: bool) -> DataFrame:
    """Levels of every block: ``node`` becomes the block's top on its first
    row. With ``keep`` the siblings stay, as left0, right0, left1, ..."""
    kept: list[str] = []
    others = [c for c in nodes.columns if c != "node"]
    for level in range(DEEP):
        left, right = f"left{level}", f"right{level}"
        fetched = [f"{sql} as {name}" for sql, name in zip(_siblings(level), (left, right))]
        # The parent on its first child's row; a tree's last node stays as it is.
        parent = (f"case when place % {ARITY ** (level + 1)} = 0 then "
                  f"case when {left} is null then node else sha2(cast(concat(node, {right}) as binary), 256) end end as node")
        nodes = nodes.selectExpr("*", *fetched)
        kept += [left, right] if keep else []
        nodes = nodes.selectExpr(*others, *kept, parent)
    return nodes


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {ARITY ** DEEP}"))


def _tops(nodes: DataFrame) -> DataFrame:
    """(tree, place, nodes, node) of the next tier."""
    top = _climb(_blocks(nodes.select("tree", "place", "nodes", "node")), False).filter(F.col("place") % ARITY ** DEEP == 0)
    span = ARITY ** DEEP
    return top.select("tree", F.col("block").alias("place"), F.expr(f"(nodes + {span - 1}) div {span}").alias("nodes"), "node")


def _paths(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """``nodes`` with ``path``: the siblings of each node on its way to the
    tree's top, level by level. ``above`` holds the paths of the next tier."""
    rows = _climb(_blocks(nodes).withColumn("own", F.col("node")), True)
    # The first row of an ancestor's leaves comes before all others of them.
    levels = ", ".join(f"struct(last(left{k}, true) {ORDER} as left, last(right{k}, true) {ORDER} as right)" for k in range(DEEP))
    rows = rows.selectExpr(*[c for c in nodes.columns if c != "node"], "own as node", "block", f"array({levels}) as path")
    rows = rows.withColumn("path", F.expr("filter(path, s -> s.left is not null)"))
    if above is not None:
        up = above.select(F.col("tree").alias("_tree"), F.col("place").alias("_block"), F.col("path").alias("_up"))
        rows = (rows.join(up, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block")))
                .withColumn("path", F.concat("path", "_up")).drop("_tree", "_block", "_up"))
    return rows.drop("block")


def tree_paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``nodes`` (tree, place from 0, nodes of the tree, node, ...): the
    top of every tree (tree, top), and ``nodes`` with their ``path``."""
    tiers = [nodes]
    # A tier below the first is written: it is read for its tops and its paths.
    while True:
        tier = materialize(_tops(tiers[-1]), "merkle-tier")
        tiers.append(tier)
        if tier.filter("nodes > 1").isEmpty():
            break
    tops = tiers.pop().select("tree", F.col("node").alias("top"))
    paths = None
    for tier in reversed(tiers[1:]):
        paths = materialize(_paths(tier, paths), "merkle-paths")
        discard(tier)
    return tops, _paths(nodes, paths)


# --- the manifest -----------------------------------------------------------------

def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to over its siblings."""
    return F.aggregate(path, leaf, lambda node, s: sha(F.concat(s["left"], node, s["right"])))


def proof_hash(path: Column) -> Column:
    return sha(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def manifest(docs: DataFrame, changed: Column | None = None, change=tampered_text) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, path (the
    siblings on the way to the root) and claimed: the leaf of the document as
    it stands now, with ``change`` applied to the text where ``changed``."""
    leaf = leaf_hash(F.col("text"))
    leaves = docs.select("doc_id", "source", leaf.alias("node"),
                         (leaf if changed is None else F.when(changed, leaf_hash(change(F.col("text")))).otherwise(leaf)).alias("claimed"))
    # Written without the texts: what follows reads the digests several times.
    leaves = materialize(leaves, "merkle-leaves")
    placed = materialize(
        with_group_positions(leaves, "source", "doc_id", "node", column="_at", size_column="nodes")
        .select(F.col("source").alias("tree"), (F.col("_at") - 1).alias("place"), "nodes", "node", "doc_id", "claimed"), "merkle-places")
    discard(leaves)
    subroots, paths = tree_paths(placed)
    every = F.lit("all")
    ordered = with_group_positions(subroots.withColumn("every", every), "every", "tree", column="_at", size_column="nodes")
    upper = materialize(ordered.select(F.col("every").alias("tree"), (F.col("_at") - 1).alias("place"), "nodes",
                                       F.col("top").alias("node"), F.col("tree").alias("source")), "merkle-subroots")
    root, upper_paths = tree_paths(upper)
    by_source = upper_paths.select(F.col("source").alias("_source"), F.col("node").alias("subroot"),
                                   root.select("top").scalar().alias("root"), F.col("path").alias("_rest"))
    return (paths.join(materialize(by_source, "merkle-sources"), F.col("tree").eqNullSafe(F.col("_source")))
            .select("doc_id", F.col("tree").alias("source"), F.col("node").alias("leaf"), "claimed", "subroot", "root",
                    F.concat("path", "_rest").alias("path")))


def verify(entries: DataFrame) -> DataFrame:
    """``manifest`` rows with the proof's hash, the root that the claimed leaf
    folds to and whether it is the manifest's."""
    return (entries.withColumns({"proof_sha256": proof_hash(F.col("path")), "folded_root": fold(F.col("claimed"), F.col("path"))})
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def merkle_report(docs: DataFrame) -> DataFrame:
    """The registered query: the manifest, with every second document tampered with."""
    return verify(manifest(docs, is_tampered(F.col("doc_id")))).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def oracle_sql() -> str:
    fields = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in FIELDS)
    # CRC-32, byte by byte, eight shifts each.
    crc = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""

    def tree(name: str, source: str) -> str:
        return f"""{name} AS (
  {source}
  UNION ALL
  SELECT tree, level + 1, list_transform(range(0, len(nodes), {ARITY}), lambda i: sha256(array_to_string(nodes[i + 1:i + {ARITY}], '')))
  FROM {name} WHERE len(nodes) > 1)"""

    def siblings(rows: str, levels: str) -> str:
        number = f"(place // ({ARITY} ** level)::BIGINT)"
        first = f"({number} // {ARITY} * {ARITY})"
        return f"""
  SELECT r.id, list([array_to_string(nodes[{first} + 1:{number}], ''), array_to_string(nodes[{number} + 2:{first} + {ARITY}], '')]
                    ORDER BY level) FILTER (len(nodes) > 1) AS path
  FROM {rows} r JOIN {levels} t ON r.tree IS NOT DISTINCT FROM t.tree GROUP BY r.id"""

    return f"""
WITH RECURSIVE d AS (SELECT *, coalesce({crc} % 2 = 0, false) AS hit FROM documents),
fields AS (
  SELECT doc_id, source AS tree, sha256({fields}) AS leaf,
         sha256({fields.replace("|| text END", "|| replace(text, chr(10), '') END").replace("strlen(text::VARCHAR)", "strlen(replace(text, chr(10), ''))")}) AS changed, hit
  FROM d),
l AS (
  SELECT row_number() OVER () AS id, doc_id, tree, leaf, CASE WHEN hit THEN changed ELSE leaf END AS claimed,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM fields),
{tree("t", "SELECT tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM l GROUP BY tree")},
s AS (
  SELECT row_number() OVER () AS id, tree AS source, nodes[1] AS subroot, 'all' AS tree,
         row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place
  FROM t WHERE len(nodes) = 1),
{tree("u", "SELECT 'all' AS tree, 0 AS level, list(subroot ORDER BY place) AS nodes FROM s GROUP BY ALL")},
lp AS ({siblings("l", "t")}),
sp AS ({siblings("s", "u")}),
p AS (
  SELECT l.doc_id, l.leaf, l.claimed, s.subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root,
         list_concat(coalesce(lp.path, []), coalesce(sp.path, [])) AS path
  FROM l JOIN s ON l.tree IS NOT DISTINCT FROM s.source JOIN lp ON lp.id = l.id JOIN sp ON sp.id = s.id),
f AS (
  SELECT *, sha256(array_to_string(flatten(path), '')) AS proof_sha256,
         list_reduce(list_prepend([claimed, ''], path), lambda a, b: [sha256(b[1] || a[1] || b[2]), ''])[1] AS folded_root
  FROM p)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f"""
