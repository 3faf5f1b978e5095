"""SQL for scored text search: an independent formulation over single word positions."""

from __future__ import annotations

WORDS = r"[\p{L}\p{N}_]+"
K1, B = 1.2, 0.75


def words_sql(columns: dict[str, str], source: str = "content") -> str:
    """``words(uid, field, pos, term)`` and the field figures."""
    parts = [
        f"""SELECT uid, '{field}' AS field, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos
    FROM (SELECT uid, regexp_extract_all(lower({column}), '{WORDS}') AS t FROM {source})"""
        for field, column in columns.items()
    ]
    union = "\n  UNION ALL\n  ".join(parts)
    return f"""words AS MATERIALIZED ({union}),
sizes AS (SELECT uid, field, count(*) AS dl FROM words GROUP BY ALL),
fields AS (SELECT field, count(*) AS n, avg(dl) AS mean FROM sizes GROUP BY field)"""


def _test(word: str, prefix: bool) -> str:
    return f"starts_with(term, '{word}')" if prefix else f"term = '{word}'"


def clause_sql(number: int, kind: str, field: str, words: list[str], boost: float = 1.0) -> str:
    """CTE ``c<number>(uid, score)`` of one clause."""
    name = f"c{number}"
    if kind == "any":
        words = list(dict.fromkeys(words))
    tests = [_test(w, kind == "prefix" and i == len(words) - 1) for i, w in enumerate(words)]
    hits = " UNION ALL ".join(
        f"SELECT uid, {i} AS i, pos FROM words WHERE field = '{field}' AND {test}" for i, test in enumerate(tests)
    )
    idf = "ln(1 + (n - df + 0.5) / (df + 0.5))"
    norm = f"{K1} * (1 - {B} + {B} * dl / mean)"
    head = f"""{name}_hit AS ({hits}),
{name}_df AS (SELECT i, count(DISTINCT uid) AS df FROM {name}_hit GROUP BY i)"""
    if kind == "any":
        return f"""{head},
{name} AS (
  SELECT h.uid, {boost} * sum({idf} * tf * {K1 + 1} / (tf + {norm})) AS score
  FROM (SELECT uid, i, count(*) AS tf FROM {name}_hit GROUP BY ALL) h
  JOIN {name}_df USING (i) JOIN fields ON field = '{field}'
  JOIN sizes s ON s.uid = h.uid AND s.field = '{field}' GROUP BY h.uid)"""
    slop = 2 if kind == "phrase" else 0
    if len(set(tests)) < len(tests):
        spread = _spread_by_join(name, len(words), slop)
    else:
        spread = f"""SELECT uid, min(s) AS spread FROM (
    SELECT uid, pos - i - d AS m, s FROM {name}_hit, range({slop + 1}) a(d), range({slop + 1}) b(s)
    WHERE d <= s GROUP BY uid, m, s HAVING count(DISTINCT i) = {len(words)}) GROUP BY uid"""
    return f"""{head},
{name}_spread AS ({spread}),
{name}_idf AS (SELECT sum({idf}) AS weight FROM {name}_df JOIN fields ON field = '{field}'),
{name} AS (
  SELECT p.uid, {boost} * weight * (1.0 / (1 + spread)) * {K1 + 1} / (1.0 / (1 + spread) + {norm}) AS score
  FROM {name}_spread p CROSS JOIN {name}_idf JOIN fields f ON f.field = '{field}'
  JOIN sizes s ON s.uid = p.uid AND s.field = '{field}')"""


def _spread_by_join(name: str, n: int, slop: int) -> str:
    """Every choice of different positions: needed where a word repeats."""
    aligned = [f"(h{i}.pos - {i})" for i in range(n)]
    low, high = f"least({', '.join(aligned)})", f"greatest({', '.join(aligned)})"
    joins = f"{name}_hit h0"
    for i in range(1, n):
        apart = " AND ".join(f"h{i}.pos <> h{j}.pos" for j in range(i))
        near = " AND ".join(f"abs({aligned[i]} - {aligned[j]}) <= {slop}" for j in range(i))
        joins += f" JOIN {name}_hit h{i} ON h{i}.uid = h0.uid AND h{i}.i = {i} AND {apart} AND {near}"
    return f"SELECT h0.uid, min({high} - {low}) AS spread FROM {joins} WHERE h0.i = 0 GROUP BY h0.uid"


def search_sql(
    prelude: str,
    columns: dict[str, str],
    clauses: list[tuple],
    select: str,
    *,
    source: str = "content",
    tail: str = "",
) -> str:
    """``hits`` is every matching document with its score; ``select`` reads it."""
    ctes = ",\n".join(clause_sql(i, *clause) for i, clause in enumerate(clauses))
    union = " UNION ALL ".join(f"SELECT uid, score FROM c{i}" for i in range(len(clauses)))
    return f"""WITH {prelude},
{words_sql(columns, source)},
{ctes},
hits AS (SELECT uid, sum(score) AS score FROM ({union}) GROUP BY uid){tail}
{select}"""
