"""DuckDB SQL for the text queries that SQL can express."""

from ratingloom.llm.quotations import ATTRIBUTION, MARKS, STOP
from ratingloom.llm.spotsigs import ANCHORS

EXACT_DEDUP = """
WITH normalised AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM normalised WINDOW same AS (PARTITION BY text)
"""

MIXING = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':'
                             || row_number() OVER (PARTITION BY source, doc_id, coalesce(text, '')) - 1), 1, 15))::BIGINT AS key
  FROM documents
),
named AS (
  SELECT *, [5, 2, 1][1 + ordinal % 3] AS weight
  FROM (SELECT source, count(*) AS docs, sum(size)::BIGINT AS words,
               row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS ordinal FROM sized GROUP BY source)
),
shared AS (
  SELECT *, sum(words) OVER ()::BIGINT AS all_words,
         coalesce(sum(words) OVER earlier, 0)::BIGINT AS before,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS still_open
  FROM named
  WINDOW earlier AS (ORDER BY words::DOUBLE / weight, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
stopping AS (
  SELECT *, 4 * words * still_open < weight * (3 * all_words - 4 * before) AS stops FROM shared
),
targets AS (
  SELECT source, ordinal, docs, words,
         CASE WHEN stops THEN 2.0::DOUBLE * words
              ELSE weight * (1.5::DOUBLE * all_words
                             - 2.0::DOUBLE * (sum(CASE WHEN stops THEN words ELSE 0 END) OVER ())::BIGINT)
                   / (sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::BIGINT END AS target
  FROM stopping
),
passes AS (
  SELECT *, CASE WHEN words > 0 THEN least(floor(target / words), 2)::BIGINT ELSE 0 END AS full_passes,
         len(bin(docs >> 8)) - 1 AS bits
  FROM targets
),
rests AS (SELECT *, greatest(0, target - full_passes * words) AS rest FROM passes),
placed AS (
  SELECT doc_id, size, key, r.*, key >> (60 - bits) AS block
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
),
running AS (
  SELECT ordinal, block, any_value(rest) AS rest, sum(size)::BIGINT AS in_block,
         (sum(sum(size)) OVER (PARTITION BY ordinal ORDER BY block))::BIGINT AS until
  FROM placed GROUP BY ordinal, block
),
cuts AS (
  SELECT ordinal, block AS cut, rest - until + in_block AS gap FROM running
  WHERE until > rest AND until - in_block <= rest
),
inside AS (
  SELECT p.ordinal, p.size, p.key, c.gap,
         row_number() OVER (PARTITION BY p.ordinal ORDER BY p.size DESC, p.key) AS n
  FROM placed p JOIN cuts c ON p.ordinal = c.ordinal AND p.block = c.cut
  WHERE p.size > 0
),
picking AS (
  SELECT ordinal, n, key, size <= gap AS pick, CASE WHEN size <= gap THEN gap - size ELSE gap END AS gap
  FROM inside WHERE n = 1
  UNION ALL
  SELECT i.ordinal, i.n, i.key, i.size <= p.gap, CASE WHEN i.size <= p.gap THEN p.gap - i.size ELSE p.gap END
  FROM picking p JOIN inside i ON i.ordinal = p.ordinal AND i.n = p.n + 1
)
SELECT doc_id, size, words AS source_size, target,
       size * (full_passes + CASE
         WHEN rest <= 0 THEN 0
         WHEN c.cut IS NULL OR block < c.cut THEN 1
         WHEN block = c.cut AND (p.ordinal, key) IN (SELECT (ordinal, key) FROM picking WHERE pick) THEN 1
         ELSE 0 END) AS taken
FROM placed p LEFT JOIN cuts c ON p.ordinal = c.ordinal
"""

_ANCHORS = ", ".join(f"'{word}'" for word in ANCHORS)


def _signatures(text: str) -> str:
    """The sorted distinct signatures of a text, as a list expression."""
    return f"""(
  SELECT list_sort(list_distinct(list_transform(
    CASE WHEN len(words) > 0 THEN ['^ ' || array_to_string(content[1:2], ' ')] ELSE []::VARCHAR[] END
      || list_transform(anchors, lambda i, k: words[i] || ' ' || array_to_string(content[i - k + 1 : i - k + 2], ' ')),
    lambda s: substr(to_base64(unhex(substr(md5(s), 1, 18))), 1, 6))))
  FROM (SELECT words, list_filter(words, lambda w: NOT list_contains([{_ANCHORS}], w)) AS content,
               list_filter(range(1, len(words) + 1), lambda i: list_contains([{_ANCHORS}], words[i])) AS anchors
        FROM (SELECT list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words)))"""


def _likeness(one: str, other: str) -> str:
    shared = f"len(list_intersect({one}, {other}))::DOUBLE"
    return (
        f"CASE WHEN {one} = {other} THEN 1.0::DOUBLE WHEN len({one}) = 0 OR len({other}) = 0 THEN 0.0::DOUBLE"
        f" ELSE {shared} / (len({one}) + len({other}) - {shared}) END"
    )


FINGERPRINTS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM documents),
followed AS (
  SELECT doc_id, text, n_chars,
         coalesce(lead(text) OVER down, first_value(text) OVER (ORDER BY doc_id DESC)) AS following
  FROM texts WINDOW down AS (ORDER BY doc_id DESC)
),
edited AS (
  SELECT doc_id, text, n_chars, following,
         substring(text, 1, n_chars - n_chars // 3) || substring(following, 1, n_chars // 3) AS edited
  FROM followed
),
signed AS (
  SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
         {_signatures("e.text")} AS own, {_signatures("e.edited")} AS changed, {_signatures("e.following")} AS after
  FROM edited e
)
SELECT doc_id, n_chars, edited_sha256, array_to_string(own, ' ') AS fingerprint,
       array_to_string(changed, ' ') AS edited_fingerprint,
       {_likeness("own", "changed")} AS near_edited, {_likeness("own", "after")} AS near_next
FROM signed
"""

QUOTATION_LINKS = rf"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role,
         regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n') AS raw
  FROM conversations
),
split AS (SELECT id, conv_id, turn, unnest(raw) AS raw, generate_subscripts(raw, 1) AS n FROM messages),
marked AS (
  SELECT id, conv_id, turn, n, regexp_replace(raw, '{MARKS}', '') AS body,
         length(regexp_replace(regexp_extract(raw, '{MARKS}', 1), '[ \t]', '', 'g')) AS depth
  FROM split
),
below AS (SELECT *, lead(depth) OVER (PARTITION BY id ORDER BY n) AS below FROM marked),
headed AS (SELECT *, coalesce(below > depth AND regexp_matches(body, '{ATTRIBUTION}'), FALSE) AS head FROM below),
lines AS (
  SELECT id, conv_id, turn, n, body, head, CASE WHEN head THEN below ELSE depth END AS level,
         trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS said
  FROM headed
),
runs AS (
  SELECT id, conv_id, turn, level, n, body, n - row_number() OVER (PARTITION BY id, level ORDER BY n) AS run
  FROM lines WHERE NOT head AND said <> ''
),
sentences AS (
  SELECT conv_id, turn, level, unnest(regexp_split_to_array(string_agg(body, ' ' ORDER BY n), '{STOP}')) AS body
  FROM runs GROUP BY id, conv_id, turn, level, run
),
passages AS (
  SELECT conv_id, turn, level, said, 1 AS as_line FROM lines WHERE NOT head
  UNION ALL
  SELECT conv_id, turn, level, trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), 0 FROM sentences
),
origins AS (
  SELECT conv_id, said, min(turn) AS origin FROM passages WHERE level = 0 AND said <> '' GROUP BY ALL
),
quotes AS (
  SELECT conv_id, turn, level, said, sum(as_line)::BIGINT AS lines,
         greatest(sum(as_line), count(*) - sum(as_line))::BIGINT AS times
  FROM passages WHERE level > 0 AND said <> '' GROUP BY ALL
),
found AS (
  SELECT q.conv_id, q.turn, origin, sum(lines) AS lines, sum(times) AS times,
         coalesce(sum(times) FILTER (level = 1), 0) AS direct
  FROM quotes q JOIN origins o ON q.conv_id = o.conv_id AND q.said = o.said
  WHERE origin < turn GROUP BY ALL
),
links AS (
  SELECT conv_id, turn, sum(lines)::BIGINT AS linked_lines, sum(times)::BIGINT AS linked_passages,
         list_sort(list(origin)) AS quoted_turns,
         arg_max(origin, (direct, origin)) FILTER (direct > 0) AS parent_turn
  FROM found GROUP BY ALL
),
threads AS (
  SELECT conv_id, turn, turn AS thread, 0::BIGINT AS depth
  FROM (SELECT DISTINCT conv_id, turn FROM messages) m
  WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.conv_id = m.conv_id AND l.turn = m.turn AND parent_turn IS NOT NULL)
  UNION ALL
  SELECT l.conv_id, l.turn, t.thread, t.depth + 1
  FROM threads t JOIN links l ON l.conv_id = t.conv_id AND l.parent_turn = t.turn
),
own AS (
  SELECT id, coalesce(string_agg(body, chr(10) ORDER BY n) FILTER (level = 0), '') AS text,
         max(level)::INTEGER AS quote_levels,
         count(*) FILTER (level > 0 AND NOT head AND said <> '') AS quoted_lines
  FROM lines GROUP BY id
)
SELECT m.conv_id, m.turn, role, regexp_replace(text, '^\s*\n|\s+$', '', 'g') AS text, quote_levels, quoted_lines,
       coalesce(linked_lines, 0) AS linked_lines, coalesce(linked_passages, 0) AS linked_passages,
       parent_turn, coalesce(quoted_turns, []::BIGINT[]) AS quoted_turns, thread, depth
FROM messages m JOIN own USING (id) LEFT JOIN links l ON m.conv_id = l.conv_id AND m.turn = l.turn
JOIN threads t ON m.conv_id IS NOT DISTINCT FROM t.conv_id AND m.turn IS NOT DISTINCT FROM t.turn
"""

LEXICAL_SEARCH = r"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
kept AS (SELECT id, doc_id, terms, len(terms)::HUGEINT AS n FROM found WHERE len(terms) > 0),
totals AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS words FROM kept),
sized AS (SELECT id, doc_id, (100 - 50 + (50 * n * docs) // words)::BIGINT AS m FROM kept, totals),
postings AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM kept) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term
),
asked AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
scores AS (
  SELECT item_id, id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sized USING (id) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, id)::INTEGER AS rank
      FROM scores JOIN sized USING (id) WHERE score > 0)
WHERE rank <= 50
"""

# The polynomial and start value of CRC-32 are fixed.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: unicode(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (SELECT unnest([1, 2]) AS copy) WHERE fault <> 0 AND (copy = 1 OR fault = 3)
),
numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER turns AS n, lag(left(role, 1)) OVER turns AS before,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM damaged WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
flagged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS flaw
  FROM numbered
),
counted AS (
  SELECT conv_id, count(*) AS last, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (flaw = 'blank') AS blank, count(*) FILTER (flaw = 'duplicate') AS duplicate,
         count(*) FILTER (flaw = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY conv_id
),
inserts(state, after, letters, messages, price) AS (
  VALUES (0, 0, '', [], 0), (0, 2, 'I', ['user:'], 5), (0, 3, 'II', ['user:', 'assistant:'], 10),
         (1, 1, '', [], 0), (1, 2, 'I', ['user:'], 5), (1, 3, 'II', ['user:', 'assistant:'], 10),
         (2, 2, '', [], 0), (2, 3, 'I', ['assistant:'], 5), (2, 2, 'II', ['assistant:', 'user:'], 10),
         (3, 3, '', [], 0), (3, 2, 'I', ['user:'], 5), (3, 3, 'II', ['user:', 'assistant:'], 10)
),
steps(after, initial, target, full_role) AS (
  VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (3, 'u', 2, 'user'), (2, 'a', 3, 'assistant')
),
best AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS said FROM counted
  UNION ALL
  SELECT conv_id, n, target, least_of.cost, least_of.audit, least_of.said
  FROM (
    SELECT conv_id, n, target, min(struct_pack(cost := price, audit := path, said := words)) AS least_of
    FROM (
      SELECT b.conv_id, f.n, e.target, b.cost + i.price + e.price AS price,
             b.audit || i.letters || e.letter AS path, b.said || i.messages::VARCHAR[] || e.words AS words
      FROM best b
      JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.n + 1
      JOIN inserts i ON i.state = b.state,
      LATERAL (
        SELECT i.after AS target, 2 AS price, 'D' AS letter, []::VARCHAR[] AS words
        UNION ALL
        SELECT s.target, CASE WHEN f.flaw = 'truncated' THEN 5 ELSE 0 END, 'K', [f.role || ':' || f.text]
        FROM steps s WHERE s.after = i.after AND s.initial = f.initial AND f.flaw NOT IN ('blank', 'duplicate')
        UNION ALL
        SELECT s.target, CASE WHEN f.flaw = 'truncated' THEN 6 ELSE 1 END, 'R', [s.full_role || ':' || f.text]
        FROM steps s WHERE s.after = i.after AND s.full_role IS NOT NULL AND f.flaw NOT IN ('blank', 'duplicate')
      ) e
    ) GROUP BY conv_id, n, target
  )
),
ended AS (
  SELECT b.conv_id, min(struct_pack(cost := b.cost + i.price, audit := b.audit || i.letters, said := b.said || i.messages::VARCHAR[])) AS least_of
  FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.last = b.n
  JOIN inserts i ON i.state = b.state WHERE i.after IN (0, 3) GROUP BY b.conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.least_of.cost, 0)::BIGINT AS cost,
       coalesce(e.least_of.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.least_of.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLES: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op3_quotation_links": QUOTATION_LINKS,
    "op5_mixing": MIXING,
    "op8_fingerprints": FINGERPRINTS,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}
