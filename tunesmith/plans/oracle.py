"""DuckDB definitions of the record views, for the SQL cross-check.

Only the driver tables are registered on the DuckDB side, so every oracle
query carries the views it needs as common table expressions.
:func:`with_views` adds them (and what they depend on) in order.
"""

from __future__ import annotations

import re

# name -> (body, dependencies)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = (body.strip(), deps)


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in VIEWS[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it mentions (``v_…`` names)."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0]}\n)" for n in _order(used))
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def md5_key(expr: str, seed: int = 42) -> str:
    return f"md5(concat('{seed}:', CAST({expr} AS VARCHAR)))"


WORDS = "list_filter(regexp_split_to_array({x}, '[ \\n\\t\\r]+'), lambda w: w <> '')"


def words(x: str) -> str:
    return WORDS.format(x=x)


def chars(x: str) -> str:
    return f"regexp_extract_all({x}, '(?s).')"


def chatml_msg(role: str, content: str) -> str:
    return f"concat('<|im_start|>', {role}, chr(10), {content}, '<|im_end|>', chr(10))"


view("v_system", """
SELECT conv_id, text AS system FROM conversations WHERE role = 'system'
""")

view("v_instruction", """
SELECT u.conv_id, u.turn, u.text AS instruction,
       coalesce(s.system, '') AS input, a.text AS output, s.system
FROM conversations u
JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
LEFT JOIN v_system s ON s.conv_id = u.conv_id
WHERE u.role = 'user'
""", ("v_system",))

view("v_comparison", """
SELECT conv_id, instruction, [a1, a2] AS output FROM (
  SELECT conv_id,
         max(CASE WHEN role = 'user' AND rn = 1 THEN text END) AS instruction,
         max(CASE WHEN role = 'assistant' AND rn = 1 THEN text END) AS a1,
         max(CASE WHEN role = 'assistant' AND rn = 2 THEN text END) AS a2
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn
        FROM conversations WHERE role IN ('user', 'assistant'))
  WHERE rn <= 2
  GROUP BY conv_id)
WHERE a2 IS NOT NULL
""")

view("v_question_pair", """
SELECT c.conv_id, coalesce(s.system, '') AS system, c.instruction AS question,
       c.output[1] AS chosen, c.output[2] AS rejected
FROM v_comparison c LEFT JOIN v_system s ON s.conv_id = c.conv_id
""", ("v_comparison", "v_system"))

view("v_messages", """
SELECT conv_id,
       list({'role': role, 'content': text} ORDER BY turn) AS messages
FROM conversations GROUP BY conv_id
""")

view("v_dialogue", """
SELECT conv_id,
       string_agg(CASE WHEN role = 'user' THEN concat(chr(10), chr(10), 'Human: ', text)
                       ELSE concat(chr(10), chr(10), 'Assistant: ', text) END,
                  '' ORDER BY turn) AS text
FROM conversations WHERE role <> 'system' GROUP BY conv_id
""")

view("v_predictions", """
SELECT a.conv_id, a.turn, a.text AS predict, u.text AS labels
FROM conversations a
JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user'
WHERE a.role = 'assistant'
""")

# Corpus vocabulary over all conversation turns: id by (count desc, token).
view("v_vocab", f"""
SELECT token, cnt AS count,
       CAST(row_number() OVER (ORDER BY cnt DESC, token ASC) + 3 AS BIGINT) AS id
FROM (SELECT token, count(*) AS cnt
      FROM (SELECT unnest({words('text')}) AS token FROM conversations)
      GROUP BY token)
""")

view("v_doc_vocab", f"""
SELECT token, cnt AS count,
       CAST(row_number() OVER (ORDER BY cnt DESC, token ASC) + 3 AS BIGINT) AS id
FROM (SELECT token, count(*) AS cnt
      FROM (SELECT unnest({words('text')}) AS token FROM documents)
      GROUP BY token)
""")


def encode_sql(source: str, keys, text: str, max_len: int | None,
               special: bool, vocab: str = "v_vocab", out: str = "ids") -> str:
    """Rows ``keys…, out``: words -> vocabulary ids (unknown -> 3), an
    optional leading bos (2), cut to ``max_len`` including the bos."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    kl = ", ".join(keys)
    keep = None if max_len is None else (max_len - (1 if special else 0))
    toks = words(text)
    if keep is not None:
        toks = f"{toks}[1:{keep}]"
    ids = "coalesce(e.ids, CAST([] AS BIGINT[]))"
    if special:
        ids = f"list_concat([CAST(2 AS BIGINT)], {ids})"
    on = " AND ".join(f"s.{k} = e.{k}" for k in keys)
    return f"""(
SELECT {', '.join('s.' + k for k in keys)}, {ids} AS {out}
FROM {source} s
LEFT JOIN (
  SELECT {kl}, list(CAST(coalesce(v.id, 3) AS BIGINT) ORDER BY t.pos) AS ids
  FROM (SELECT {kl}, unnest(w) AS token, generate_subscripts(w, 1) AS pos
        FROM (SELECT {kl}, {toks} AS w FROM {source})) t
  LEFT JOIN {vocab} v ON v.token = t.token
  GROUP BY {kl}) e ON {on})"""
