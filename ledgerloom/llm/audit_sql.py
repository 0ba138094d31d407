"""SQL that checks the corpus audit and the repair of conversations."""

# The checksum byte by byte, eight steps each; its polynomial is a fixed value.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({key}, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), said AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM said GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, sum(n) + 5 * count(*) AS size FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
  SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)
         + 5 * (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS size
  FROM groups g
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // s.size::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // l.size::HUGEINT AS q
  FROM sizes s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM shares a JOIN shares b USING (lang, term)
  WHERE a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS f
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, encode(item)) AS rank FROM parts
)
SELECT lang, source, part, item, f::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def _then(way: str, cost: str, edit: str) -> str:
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {cost}, 'a': {way}.a || '{edit}'}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_IN2 = _least("s2", *(_then(s, "2", "I") for s in ("s0", "s1", "s3")))
_IN3 = _least("s3", _then("i2", "2", "I"))


def _kept(initial: str, ways: tuple[str, ...]) -> str:
    """The cheapest of keeping or renaming a turn after one of `ways`; a turn that must go gives none."""
    kept = _least(*(_then(w, "cut", "K") for w in ways))
    named = _least(*(_then(w, "cut + 2", "R") for w in ways))
    return f"CASE WHEN gone THEN NULL WHEN ini = '{initial}' THEN {kept} ELSE {named} END"


OP13_SQL = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         {_CRC32.format(key="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS harm
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt,
         unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM base
), placed AS (
  SELECT *, substr(role, 1, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt) AS pos FROM hurt
), judged AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         CASE WHEN NOT regexp_matches(txt, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY pos) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(txt, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), turns AS (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::INTEGER AS cut FROM judged
), walked AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, {{'c': 0, 'a': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR) AS s1,
         NULL::STRUCT(c INTEGER, a VARCHAR) AS s2, NULL::STRUCT(c INTEGER, a VARCHAR) AS s3
  FROM conversations
  UNION ALL
  SELECT conv_id, pos, {_then("s0", "3", "D")},
         {_least(_then("s1", "3", "D"), "CASE WHEN ini = 's' AND NOT gone THEN " + _then("s0", "cut", "K") + " END")},
         {_least(_then("i2", "3", "D"), _kept("u", ("s0", "s1", "i3")))},
         {_least(_then("i3", "3", "D"), _kept("a", ("i2",)))}
  FROM (SELECT *, {_IN3} AS i3 FROM (
          SELECT t.conv_id, t.pos, t.ini, t.gone, t.cut, w.s0, w.s1, w.s2, w.s3, {_IN2} AS i2
          FROM walked w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos + 1))
), ended AS (
  SELECT conv_id, {_least("s0", "s3", _then("s2", "2", "I"), _then("s1", "4", "II"))} AS best
  FROM walked QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
), edits AS (
  SELECT conv_id, unnest(string_split(best.a, '')) AS edit, generate_subscripts(string_split(best.a, ''), 1) AS k
  FROM ended WHERE best.a <> ''
), counted AS (
  SELECT conv_id, edit, k, count(*) FILTER (WHERE edit <> 'I') OVER w AS pos, count(*) FILTER (WHERE edit <> 'D') OVER w AS nth
  FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), stays AS (
  SELECT e.conv_id, e.edit, e.k, e.nth, CASE WHEN e.edit <> 'I' THEN t.role END AS role, CASE WHEN e.edit <> 'I' THEN t.txt ELSE '' END AS txt,
         bool_or(e.nth = 1 AND e.edit = 'K' AND t.ini = 's') OVER (PARTITION BY e.conv_id) AS system
  FROM counted e LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.pos = e.pos WHERE e.edit <> 'D'
), text AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth + coalesce(system, false)::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || txt, chr(10) ORDER BY k) AS whole
  FROM stays GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.best.c::BIGINT AS cost, e.best.a AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN text x ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""
