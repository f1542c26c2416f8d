"""SQL that DuckDB runs for the results of the operators that SQL can express."""

from __future__ import annotations

from tillbook.llm import manifest, turn_repair

#: Levels of a hash tree that the SQL spells out: 16^6 nodes a source, 16^6 sources.
LEVELS = 6
#: Stands for a place that cannot be reached.
_FAR = 1_000_000_000_000


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters."""
    codes = f"list_transform(generate_series(1, length({text})), lambda i: ord(substr({text}, CAST(i AS INTEGER), 1))::BIGINT)"
    turned = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: {turned})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


# --- manifest ---------------------------------------------------------------


def _tree(prefix: str, nodes: str, key: str) -> str:
    """CTEs {prefix}0..: each level's (key, r, h, cnt), from ``nodes`` with (key, r, h)."""
    ctes = [f"{prefix}0 AS (SELECT {key}, r, h, count(*) OVER (PARTITION BY {key}) AS cnt FROM {nodes})"]
    for k in range(1, LEVELS + 1):
        ctes.append(
            f"""{prefix}{k} AS (
              SELECT *, count(*) OVER (PARTITION BY {key}) AS cnt FROM (
                SELECT {key}, r // 16 AS r,
                  CASE WHEN any_value(cnt) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY r)) END AS h
                FROM {prefix}{k - 1} GROUP BY {key}, r // 16))"""
        )
    # A node's siblings in its run; nothing above a lone node.
    for k in range(LEVELS):
        run = f"PARTITION BY {key}, r // 16 ORDER BY r"
        ctes.append(
            f"""{prefix}s{k} AS (
              SELECT {key}, r,
                CASE WHEN cnt > 1 THEN coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
                CASE WHEN cnt > 1 THEN coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS g
              FROM {prefix}{k})"""
        )
    return ",\n".join(ctes)


def manifest_sql() -> str:
    told = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(told(c) for c in manifest.LEAF_COLUMNS[:-1])} || {told(text)})"
    lowered = f"translate(text, '{manifest.UPPER}', '{manifest.LOWER}')"
    joins, steps = [], []
    for prefix, key, rank in (("n", "source", "d.r"), ("t", "one", "p.r")):
        for k in range(LEVELS):
            a = f"{prefix}{k}x"
            on = f"{a}.source IS NOT DISTINCT FROM d.source" if prefix == "n" else "TRUE"
            joins.append(f"JOIN {prefix}s{k} {a} ON {on} AND {a}.r = {rank} // {16**k}")
            steps.append(a)
    proof = " || ".join(f"coalesce({a}.l || {a}.g, '')" for a in steps)
    lists = ", ".join(f"{{'l': {a}.l, 'g': {a}.g, 'h': NULL}}" for a in steps)
    folded = f"""list_reduce(list_prepend({{'l': NULL, 'g': NULL, 'h': d.now}}, [{lists}]),
        lambda a, s: {{'l': NULL, 'g': NULL, 'h': CASE WHEN s.l IS NULL THEN a.h ELSE sha256(s.l || a.h || s.g) END}}).h"""
    return f"""
    WITH leaves AS (
      SELECT doc_id, source, {leaf('text')} AS h,
        CASE WHEN doc_id IS NOT NULL AND text IS NOT NULL AND {_crc32('CAST(coalesce(doc_id, 0) AS VARCHAR)')} % 5 = 0
          THEN {leaf(lowered)} END AS changed
      FROM documents),
    d AS (
      SELECT doc_id, source, h, coalesce(changed, h) AS now,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS r
      FROM leaves),
    {_tree('n', 'd', 'source')},
    p AS (
      SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, 1 AS one FROM n{LEVELS}),
    {_tree('t', 'p', 'one')}
    SELECT d.doc_id, d.h AS leaf, p.h AS subroot, root.h AS root, sha256({proof}) AS proof_sha256,
      {folded} AS folded_root, {folded} = root.h AS verified
    FROM d JOIN p ON p.source IS NOT DISTINCT FROM d.source {' '.join(joins)} JOIN t{LEVELS} root ON TRUE
    """


# --- turn repair ------------------------------------------------------------


def _after(state: str, cost: str, letter: str, role: str = "", text: str = "") -> str:
    """A state after an edit; written rows are appended, each behind a line break."""
    out = f"{state}.o || chr(10) || {role} || ':' || {text}" if role else f"{state}.o"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {out}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _closed(s: list[str]) -> list[str]:
    """States after rows that are put in."""
    put = lambda state, place: _after(state, str(turn_repair.INSERT), "I", f"'{turn_repair.NEEDS[place]}'", "''")
    user = _least(s[2], put(s[0], 0), put(s[1], 1), put(s[3], 3))
    return [s[0], s[1], user, _least(s[3], put("w", 2))]


def turn_repair_sql() -> str:
    """Each conversation's rows one after another, with the best way to each place of the pattern."""
    space, ends = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)", "('.', '!', '?')"
    far = f"{{'c': {_FAR}::BIGINT, 'a': '', 'o': ''}}"
    closed = _closed(["s0", "s1", "s2", "s3"])
    extra = f"CASE WHEN truncated THEN {turn_repair.TRUNCATED} ELSE 0 END"
    gone = lambda k: _after(f"c{k}", str(turn_repair.DELETE), "D")
    keep = lambda k: _after(f"c{k}", extra, "K", "role", "text")
    turn = lambda k: _after(f"c{k}", f"{turn_repair.REROLE} + {extra}", "R", f"'{turn_repair.NEEDS[k]}'", "text")
    stays = lambda letter, way, other=far: f"CASE WHEN bad THEN {far} WHEN letter = '{letter}' THEN {way} ELSE {other} END"
    steps = [
        gone(0),
        _least(gone(1), stays("s", keep(0))),
        _least(gone(2), *[stays("u", keep(k), turn(k)) for k in (0, 1, 3)]),
        _least(gone(3), stays("a", keep(2), turn(2))),
    ]
    return f"""
    WITH RECURSIVE told AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
      FROM conversations),
    faults AS (SELECT *, {_crc32('name')} % 20 AS fault FROM told),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS time
      FROM faults WHERE fault <> 0),
    marked AS (
      SELECT *, trim(text, {space}) AS trimmed, substr(role, 1, 1) AS letter,
        row_number() OVER o AS pos, lag(substr(role, 1, 1)) OVER o AS earlier_letter,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) > 1 AS again
      FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time)),
    lines AS (
      SELECT *, trimmed = '' OR again AS bad, trimmed <> '' AND NOT again AND right(trimmed, 1) NOT IN {ends} AS truncated
      FROM marked),
    counts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (trimmed = '')::BIGINT AS blank, count(*) FILTER (trimmed <> '' AND again)::BIGINT AS duplicate,
        count(*) FILTER (truncated)::BIGINT AS truncated,
        count(*) FILTER (earlier_letter || letter NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
      FROM lines GROUP BY conv_id),
    ways AS (
      SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3
      FROM told GROUP BY conv_id
      UNION ALL
      SELECT conv_id, pos, {steps[0]}, {steps[1]}, {steps[2]}, {steps[3]}
      FROM (SELECT *, {closed[3]} AS c3 FROM (
        SELECT ways.conv_id, lines.pos, bad, truncated, letter, role, text, s0 AS c0, s1 AS c1, {closed[2]} AS c2, s3, {closed[2]} AS w
        FROM ways JOIN lines ON lines.conv_id IS NOT DISTINCT FROM ways.conv_id AND lines.pos = ways.pos + 1))),
    ends AS (
      SELECT conv_id, {_least('s0', closed[3])} AS best FROM (SELECT *, {closed[2]} AS w FROM ways)
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
      best.c AS cost, best.a AS audit, sha256(substr(best.o, 2)) AS repaired_sha256
    FROM ends e LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM e.conv_id
    """
