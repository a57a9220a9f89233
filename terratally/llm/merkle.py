"""Merkle manifest of a data set, with a proof for every row.

Rows are leaves of one tree per source, the sources' roots are leaves of the tree above. Levels are
built bottom up, sixteen consecutive nodes to a run. Proofs come from pointer jumping: at first a
node points to its parent and holds one step, its siblings on either side; a self-join replaces the
ancestor by the ancestor's ancestor and appends the steps, so the distance doubles until every
node points to the root. Fifteen of sixteen nodes are leaves; they wait for the paths of their runs
and take them over at the end.

No group of a source is ever gathered: places come from one range partitioning over all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terratally.functions.keys import numbered
from terratally.llm.common import ascii_lower, staged

#: Nodes in a run.
FANOUT = 16
#: Every so many checksums of an id a row is tampered with in the query.
TAMPER_STEP = 5
#: Name of the upper tree; those of the sources start with "-" (no source) or "=".
_UPPER = ""
_NO_STEPS = "cast(array() AS array<struct<left: string, right: string>>)"


def manifest(documents: DataFrame, presented: Column | None = None) -> DataFrame:
    """doc_id, leaf, presented_leaf, subroot, root and steps of every row.

    ``steps`` are the siblings to the left and right, run by run up to the root, each side as its
    digests on end. ``presented`` is the text somebody hands in to be checked, by default the text
    itself. Reads doc_id, source, lang, n_chars and text; other columns are ignored, whatever their
    names.

    A null counts as ``-``, so it differs from an empty text. Rows that repeat an id stand in the
    order of their leaves and copies have equal proofs of their own places; rows without an id come
    first. A table of one row has that leaf as root and no steps; an empty table gives no rows.
    """
    leaves = staged(_leaves(documents, presented), "leaves")
    placed = numbered(leaves, "place", [F.col("doc_id"), F.col("digest")], ["tree"])
    lower = _Tree(placed, ["doc_id", "presented_leaf"])
    tops = staged(lower.tops(), "subroots")
    upper = _Tree(
        numbered(tops.select(F.col("tree").alias("of"), "digest"), "place", [F.col("of")]).select(
            F.lit(_UPPER).alias("tree"), "place", "digest", "of"
        ),
        ["of"],
    )
    pointers = _paths(lower, upper, tops)
    # A run of leaves goes on with the path of its node, a lone leaf with that of its source.
    first = lower.levels[0]
    at_node = [
        F.col("tree") == F.col("node.tree"),
        F.col("level") == F.col("node.level"),
        F.col("place") == F.col("node.place"),
    ]
    own = first.withColumn("level", F.when(F.col("lone"), 0).otherwise(1)).join(pointers, at_node)
    step = F.when(F.col("lone"), F.expr(_NO_STEPS)).otherwise(F.array(_siblings(F.col("at"))))
    return own.select("*", F.posexplode("members").alias("at", "member")).select(
        "member.doc_id",
        F.col("member.digest").alias("leaf"),
        "member.presented_leaf",
        "subroot",
        upper.tops().select("digest").scalar().alias("root"),
        F.concat(step, "steps").alias("steps"),
    )


def verify(rows: DataFrame) -> DataFrame:
    """Digest of the proof, the root that the presented leaf leads to, and whether it is the root."""
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate(
        "steps",
        F.col("presented_leaf"),
        lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256),
    )
    proven = rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_text() -> Column:
    """The text, in lower case where the checksum of the id says so."""
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string")) % TAMPER_STEP == 0
    return F.when(chosen, ascii_lower(F.col("text"))).otherwise(F.col("text"))


def _leaves(documents: DataFrame, presented: Column | None) -> DataFrame:
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    def digest(text: Column) -> Column:
        whole = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), text]
        return F.sha2(F.concat(*(field(value) for value in whole)), 256)

    shown = F.col("text") if presented is None else presented
    return documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(F.col("text")).alias("digest"),
        digest(shown).alias("presented_leaf"),
    )


def _siblings(at: Column) -> Column:
    """What stands left and right of the member at ``at`` of its run."""
    digests = F.transform("members", lambda m: m["digest"])
    return F.struct(
        F.array_join(F.slice(digests, F.lit(1), at), "").alias("left"),
        F.array_join(F.slice(digests, at + 2, F.lit(FANOUT)), "").alias("right"),
    )


class _Tree:
    """Runs of every level over all trees of the leaves (tree, place, digest, and ``carry``).

    ``levels[k]`` has tree, place and digest of the nodes of level k + 1 and their members. A tree's
    only node ends it: it comes up once more as ``lone`` run of itself, with its own digest.
    """

    def __init__(self, leaves: DataFrame, carry: list[str]):
        last = leaves.agg(F.max("place")).first()[0]
        self.levels = [_runs(leaves, carry)]
        while last and last > 0:
            nodes = self.levels[-1].where(~F.col("lone")).select("tree", "place", "digest")
            self.levels.append(_runs(nodes, []))
            last //= FANOUT

    def tops(self) -> DataFrame:
        """tree, level and digest of each tree's last node."""
        out = None
        for level, runs in enumerate(self.levels):
            lone = runs.where("lone").select("tree", F.lit(level).alias("level"), "digest")
            out = lone if out is None else out.unionByName(lone)
        return out

    def edges(self, first: int = 0) -> DataFrame:
        """Node, parent and the one step between them, from level ``first`` on."""
        out = None
        for level, runs in enumerate(self.levels[first:], first):
            members = runs.where(~F.col("lone")).select("*", F.posexplode("members").alias("at", "member"))
            edge = members.select(
                _node(F.col("tree"), F.lit(level), F.col("member.place")).alias("node"),
                _node(F.col("tree"), F.lit(level + 1), F.col("place")).alias("ancestor"),
                F.array(_siblings(F.col("at"))).alias("steps"),
                F.lit(None).cast("string").alias("subroot"),
            )
            out = edge if out is None else out.unionByName(edge)
        return out


def _node(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.alias("tree"), level.alias("level"), place.cast("long").alias("place"))


def _runs(nodes: DataFrame, carry: list[str]) -> DataFrame:
    run = F.expr(f"place DIV {FANOUT}").alias("run")
    members = F.sort_array(F.collect_list(F.struct("place", "digest", *carry)))
    grouped = nodes.groupBy("tree", run).agg(members.alias("members"))
    lone = (F.col("run") == 0) & (F.size("members") == 1)
    digest = F.sha2(F.array_join(F.transform("members", lambda m: m["digest"]), ""), 256)
    runs = grouped.select(
        "tree",
        F.col("run").alias("place"),
        "members",
        lone.alias("lone"),
        F.when(lone, F.col("members")[0]["digest"]).otherwise(digest).alias("digest"),
    )
    return staged(runs, "runs")


def _paths(lower: _Tree, upper: _Tree, tops: DataFrame) -> DataFrame:
    """The path to the root of every node that is not a leaf, and of the lone leaves."""
    ranks = upper.levels[0].select(F.explode("members").alias("member")).select(
        F.col("member.of").alias("tree"), F.col("member.place").alias("rank")
    )
    # Rows of the upper tree are the sources' last nodes: an edge without a step.
    links = tops.join(ranks, "tree").select(
        _node(F.col("tree"), F.col("level"), F.lit(0)).alias("node"),
        _node(F.lit(_UPPER), F.lit(0), F.col("rank")).alias("ancestor"),
        F.expr(_NO_STEPS).alias("steps"),
        F.col("digest").alias("subroot"),
    )
    pointers = links.unionByName(upper.edges())
    if len(lower.levels) > 1:
        pointers = pointers.unionByName(lower.edges(1))
    pointers = staged(pointers, "pointers")
    height = len(upper.levels) - 1
    distance, longest = 1, len(lower.levels) + height
    at_root = (F.col("ancestor.tree") == _UPPER) & (F.col("ancestor.level") == height)
    while distance < longest:
        further = pointers.where(~at_root).join(
            pointers.select(
                F.col("node").alias("ancestor"),
                F.col("ancestor").alias("_ancestor"),
                F.col("steps").alias("_steps"),
                F.col("subroot").alias("_subroot"),
            ),
            "ancestor",
        )
        doubled = further.select(
            "node",
            F.col("_ancestor").alias("ancestor"),
            F.concat("steps", "_steps").alias("steps"),
            F.coalesce("subroot", "_subroot").alias("subroot"),
        )
        pointers = staged(pointers.where(at_root).unionByName(doubled), "pointers")
        distance *= 2
    return pointers


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(_field_sql(f) for f in fields)})"


def _tree_sql(name: str, leaves: str, key: str) -> str:
    """Levels of a tree, and the siblings of each node, by recursion over runs."""
    run = f"PARTITION BY {key}, level, place // {FANOUT} ORDER BY place ROWS BETWEEN"
    return f"""
{name}_nodes AS (
    SELECT {key}, 0 AS level, place, n, digest FROM {leaves}
    UNION ALL
    SELECT {key}, level + 1, place // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT},
        sha256(string_agg(digest, '' ORDER BY place))
    FROM {name}_nodes WHERE n > 1 GROUP BY {key}, level, place // {FANOUT}, n
), {name}_steps AS (
    SELECT {key}, level, place,
        coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}_nodes WHERE n > 1
)"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MANIFEST_SQL = f"""
WITH RECURSIVE bits AS (
    SELECT DISTINCT CAST(doc_id AS VARCHAR) AS digits, 0 AS bit, 4294967295::BIGINT AS crc
    FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT digits, bit + 1, xor(fed >> 1, 3988292384 * (fed & 1)) FROM (
        SELECT digits, bit,
            CASE WHEN bit % 8 = 0 THEN xor(crc, ascii(substr(digits, bit // 8 + 1, 1))) ELSE crc END AS fed
        FROM bits WHERE bit < 8 * length(digits))
), chosen AS (
    SELECT CAST(digits AS BIGINT) AS doc_id FROM bits
    WHERE bit = 8 * length(digits) AND xor(crc, 4294967295) % {TAMPER_STEP} = 0
), hashed AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '-') AS tree,
        {_leaf_sql("text")} AS digest,
        CASE WHEN doc_id IN (SELECT doc_id FROM chosen) THEN {_leaf_sql(_LOWERED)}
            ELSE {_leaf_sql("text")} END AS presented
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
        count(*) OVER (PARTITION BY tree) AS n
    FROM hashed
), {_tree_sql("lower", "leaves", "tree")},
tops AS (
    SELECT '' AS tree, tree AS of, digest, row_number() OVER (ORDER BY tree) - 1 AS place,
        count(*) OVER () AS n
    FROM lower_nodes WHERE n = 1
), {_tree_sql("upper", "tops", "tree")},
steps AS (
    SELECT x.row, s.level, s.l, s.r FROM leaves x JOIN lower_steps s
        ON s.tree = x.tree AND s.place = x.place // CAST({FANOUT} ** s.level AS BIGINT)
    UNION ALL
    SELECT x.row, 1000 + s.level, s.l, s.r FROM leaves x JOIN tops t ON t.of = x.tree
        JOIN upper_steps s ON s.place = t.place // CAST({FANOUT} ** s.level AS BIGINT)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY level) AS step FROM steps
), folds AS (
    SELECT row, 0 AS step, presented AS digest FROM leaves
    UNION ALL
    SELECT f.row, f.step + 1, sha256(s.l || f.digest || s.r)
    FROM folds f JOIN numbered s ON s.row = f.row AND s.step = f.step + 1
), folded AS (
    SELECT row, arg_max(digest, step) AS folded_root FROM folds GROUP BY row
), proofs AS (
    SELECT row, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM numbered GROUP BY row
)
SELECT x.doc_id, x.digest AS leaf, t.digest AS subroot, u.digest AS root,
    coalesce(p.proof, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = u.digest AS verified
FROM leaves x JOIN tops t ON t.of = x.tree JOIN upper_nodes u ON u.n = 1
    JOIN folded f ON f.row = x.row LEFT JOIN proofs p ON p.row = x.row
"""
