"""DuckDB SQL of op11: the same trees, level by level, with window functions."""

from __future__ import annotations

#: Levels that are written out: enough for 16 to that power of leaves in a group, and of groups.
LEVELS = 5

_CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(cast(doc_id AS varchar)) + 1), lambda i: ascii(substr(cast(doc_id AS varchar), cast(i AS int), 1))::UBIGINT)),
    lambda x, y: list_reduce(list_prepend(xor(x, y), list_transform(range(8), lambda z: z::UBIGINT)), lambda c, z: xor(c >> 1, (c & 1) * 3988292384::UBIGINT)))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(cast({value} AS varchar)) || ':' || cast({value} AS varchar), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _tree(name: str) -> str:
    """From {name}0 (g, pos, c, d): nodes of all levels, and for each level the digests left and right of a node (where it has a parent)."""
    out = []
    for k in range(LEVELS):
        runs = "PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN"
        out.append(f"""{name}s{k} AS (SELECT g, pos, coalesce(string_agg(d, '') OVER ({runs} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(d, '') OVER ({runs} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE c > 1),
        {name}{k + 1} AS (
            SELECT g, pos // 16 AS pos, (any_value(c) + 15) // 16 AS c, sha256(string_agg(d, '' ORDER BY pos)) AS d FROM {name}{k} WHERE c > 1 GROUP BY g, pos // 16
            UNION ALL SELECT g, pos, c, d FROM {name}{k} WHERE c = 1)""")
    return ",\n        ".join(out)


def _climb(name: str, start: str, path: str, key: str, place: str) -> str:
    """Steps from `start` up the tree: f folds, p gathers what is beside."""
    out, last = [], start
    for k in range(LEVELS):
        out.append(f"""{path}{k} AS (SELECT x.* REPLACE (CASE WHEN s.l IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f, CASE WHEN s.l IS NULL THEN p ELSE p || s.l || s.r END AS p)
            FROM {last} x LEFT JOIN {name}s{k} s ON s.g IS NOT DISTINCT FROM x.{key} AND s.pos = x.{place} // {16**k})""")
        last = f"{path}{k}"
    return ",\n        ".join(out)


SQL = rf"""
        WITH h AS (
            SELECT doc_id, source AS g, {_leaf('text')} AS d,
                CASE WHEN xor({_CRC}, 4294967295::UBIGINT) % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf('text')} END AS o
            FROM documents),
        a0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY g) AS c FROM h),
        {_tree('a')},
        b0 AS (SELECT 0 AS g, g AS src, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, count(*) OVER () AS c, d FROM a{LEVELS}),
        {_tree('b')},
        own AS (SELECT doc_id, a0.d AS leaf, a0.g AS g, a0.pos AS pos, b0.pos AS top, 0 AS zero, b0.d AS subroot, a0.o AS f, '' AS p FROM a0 JOIN b0 ON a0.g IS NOT DISTINCT FROM b0.src),
        {_climb('a', 'own', 'u', 'g', 'pos')},
        {_climb('b', f'u{LEVELS - 1}', 'v', 'zero', 'top')}
        SELECT doc_id, leaf, subroot, (SELECT d FROM b{LEVELS}) AS root, sha256(p) AS proof_sha256, f AS folded_root, f = (SELECT d FROM b{LEVELS}) AS verified FROM v{LEVELS - 1}"""
