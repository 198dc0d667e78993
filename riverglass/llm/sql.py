"""Queries of this subpackage as DuckDB SQL, where SQL can say them."""

from __future__ import annotations

LEVELS = 8  # of runs of 16: more than four billion leaves


def crc32(text: str) -> str:
    """The checksum of a short ASCII text, by the rule: eight shifts for each byte."""
    byte = (f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, CAST(i AS INTEGER), 1)) AS UBIGINT))")
    shift = ("list_reduce(list_prepend({0}, [CAST(k AS UBIGINT) FOR k IN range(8)]), lambda v, k: "
             "CASE WHEN (v & 1) = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END)")
    step = shift.format("xor(c, b)")
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {byte}), lambda c, b: {step}), CAST(4294967295 AS UBIGINT))"


def field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def tree(name: str, leaves: str, by: str) -> str:
    """Tables `name`0 to `name`LEVELS of (by, place, d, left, right, n): nodes and what stands beside them in their run."""
    parts, before = [], f"SELECT {by}, place, d, count(*) OVER (PARTITION BY {by}) AS n FROM {leaves}"
    beside = f"OVER (PARTITION BY {by}, place // 16 ORDER BY place ROWS BETWEEN "
    for level in range(LEVELS + 1):
        parts.append(f"""
{name}{level} AS (SELECT *,
    CASE WHEN n > 1 THEN coalesce(string_agg(d, '') {beside} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS lft,
    CASE WHEN n > 1 THEN coalesce(string_agg(d, '') {beside} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS rgt
  FROM ({before}))""")
        # A tree that has come to one node stays as it is.
        before = (f"SELECT {by}, place // 16 AS place, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY place)) END AS d, "
                  f"(any_value(n) + 15) // 16 AS n FROM {name}{level} GROUP BY {by}, place // 16")
    return ",".join(parts)


def climb(columns: str, start: str, name: str, by: str, rank: str) -> str:
    """Rows of `start` with the siblings and the folded digest carried up through the tree `name`."""
    now = start
    for level in range(LEVELS):
        now = f"""SELECT {columns}, proof || lft || rgt AS proof,
        CASE WHEN t.n > 1 THEN sha256(lft || folded || rgt) ELSE folded END AS folded
      FROM ({now}) AS x JOIN {name}{level} AS t ON t.{by} = x.{by} AND t.place = x.{rank} // {16 ** level}"""
    return now


MANIFEST = f"""
WITH rows_ AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("changed")} AS offered,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM (SELECT *, CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
                       THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed
        FROM documents)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, leaf AS d FROM rows_),
{tree("s", "leaves", "tree").strip()},
tops AS (SELECT tree AS place, d, 0 AS one FROM s{LEVELS}),
{tree("r", "tops", "one").strip()},
within AS ({climb("x.doc_id, x.leaf, x.tree, x.place", "SELECT doc_id, leaf, tree, place, '' AS proof, offered AS folded FROM leaves", "s", "tree", "place")}),
whole AS ({climb("x.doc_id, x.leaf, x.tree, x.one", "SELECT doc_id, leaf, tree, 0 AS one, proof, folded FROM within", "r", "one", "tree")})
SELECT doc_id, leaf, s{LEVELS}.d AS subroot, r{LEVELS}.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = r{LEVELS}.d AS verified
FROM whole JOIN s{LEVELS} ON s{LEVELS}.tree = whole.tree JOIN r{LEVELS} ON true"""

SQL: dict[str, str] = {"op13_merkle_manifest": MANIFEST}
