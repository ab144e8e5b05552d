"""Pieces of DuckDB SQL that the oracle queries share."""

from __future__ import annotations

# Whitespace as the word pattern sees it, for a regex engine without lookahead.
_SPACE = r"\s\p{Z}\x{85}\x{0b}"
_WORD = (
    r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}\x01]+|[{_SPACE}]+"
)

# Fixed value: the number of reserved tokens.
SPECIALS = 4


def prefixed(text: str) -> str:
    return f"CASE WHEN {text} = '' OR starts_with({text}, ' ') THEN {text} ELSE ' ' || {text} END"


def word_list(text: str) -> str:
    """Words of a text: chr(1) marks where the last space of a run begins a word."""
    marked = (
        f"regexp_replace({prefixed(text)}, '([{_SPACE}])([^{_SPACE}])', chr(1) || '\\1\\2', 'g')"
    )
    return f"regexp_extract_all({marked}, '{_WORD}')"


def byte_list(text: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::INTEGER)"
    )


def byte_pairs(source: str, *keep: str) -> str:
    """``(…, prev, next)`` for neighbouring bytes of every ``text`` in ``source``."""
    columns = "".join(f"{c}, " for c in keep)
    return (
        f"SELECT {columns}unnest(list_slice(b, 1, len(b) - 1)) AS prev, unnest(list_slice(b, 2, len(b))) AS next "
        f"FROM (SELECT {columns}{byte_list('text')} AS b FROM ({source}))"
    )


def symbol_of(byte: str) -> str:
    return (
        f"chr((CASE WHEN {byte} <= 32 THEN {byte} + 256 WHEN {byte} BETWEEN 127 AND 160 THEN {byte} + 162 "
        f"WHEN {byte} = 173 THEN 323 ELSE {byte} END)::INTEGER)"
    )


def symbols(text: str) -> str:
    """A text with one printable character per byte."""
    return f"array_to_string(list_transform({byte_list(text)}, lambda b: {symbol_of('b')}), '')"


def numbers(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def rendered(template: str, source: str = "conversations") -> str:
    """Conversations as text; ``template`` is an expression over role and text."""
    return (
        f"SELECT conv_id, string_agg({template}, '' ORDER BY turn) AS text "
        f"FROM {source} GROUP BY conv_id"
    )


ROLE_PREFIX = "role || ': ' || text || chr(10)"
HUMAN_ASSISTANT = (
    "CASE WHEN role = 'user' THEN 'Human: ' ELSE 'Assistant: ' END || text || chr(10)"
)
CHAT = "'<s>' || role || chr(10) || text || '</s>' || chr(10)"

# chosen(conv_id, turn, role, text) and rejected(…) as in tables.preferences.
PREFERENCES = """
ends AS (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY 1),
chosen AS (SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c
           JOIN ends e ON c.conv_id = e.conv_id AND c.turn <= e.last),
placed AS (SELECT conv_id, last,
                  row_number() OVER (ORDER BY md5('7:0:' || conv_id), conv_id) - 1 AS pos,
                  count(*) OVER () AS n_rows FROM ends),
answers AS (SELECT p.conv_id, p.last, c.text FROM placed p
            JOIN placed q ON q.pos = (p.pos + 1) % p.n_rows
            JOIN chosen c ON c.conv_id = q.conv_id AND c.turn = q.last),
rejected AS (SELECT c.conv_id, c.turn, c.role,
                    CASE WHEN c.turn = a.last THEN a.text ELSE c.text END AS text
             FROM chosen c JOIN answers a ON c.conv_id = a.conv_id)"""


def bpe(corpus: str, merges: int) -> str:
    """CTEs that learn ``merges`` merges from the texts of ``corpus``, one per step.

    ``learned(word, s)`` spells every word in characters 256 + id; ``tokens(id,
    token, l, r, rank)`` lists letters and merged tokens.
    """
    first = 256 + SPECIALS
    ctes = [
        f"counts AS MATERIALIZED (SELECT word, count(*) AS n FROM "
        f"(SELECT unnest({word_list('text')}) AS word FROM ({corpus})) GROUP BY word)",
        f"spelled AS MATERIALIZED (SELECT word, n, {symbols('word')} AS s FROM counts)",
        "letters AS MATERIALIZED (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS i FROM "
        "(SELECT DISTINCT substr(s, p, 1) AS symbol FROM "
        "(SELECT s, unnest(range(1, length(s) + 1)) AS p FROM spelled)))",
        "alphabet AS MATERIALIZED (SELECT string_agg(symbol, '' ORDER BY i) AS letters, "
        f"string_agg(chr(({first} + i)::INTEGER), '' ORDER BY i) AS codes, count(*) AS size FROM letters)",
        "w0 AS MATERIALIZED (SELECT word, n, translate(s, letters, codes) AS s FROM spelled, alphabet)",
        f"t0 AS MATERIALIZED (SELECT chr(({first} + i)::INTEGER) AS c, symbol AS token, "
        "NULL::VARCHAR AS l, NULL::VARCHAR AS r, NULL::INTEGER AS rank FROM letters)",
    ]
    for k in range(1, merges + 1):
        code = f"chr(({first + k - 1} + size)::INTEGER)"
        ctes += [
            f"b{k} AS MATERIALIZED (SELECT substr(s, p, 2) AS pair, sum(n) AS total FROM "
            f"(SELECT s, n, unnest(range(1, length(s))) AS p FROM w{k - 1}) "
            "GROUP BY pair ORDER BY total DESC, pair LIMIT 1)",
            f"w{k} AS MATERIALIZED (SELECT word, n, replace(s, pair, {code}) AS s "
            f"FROM w{k - 1}, b{k}, alphabet)",
            f"t{k} AS MATERIALIZED (SELECT * FROM t{k - 1} UNION ALL "
            f"SELECT {code}, x.token || y.token, x.token, y.token, {k - 1} FROM b{k}, alphabet, "
            f"t{k - 1} x, t{k - 1} y WHERE x.c = substr(pair, 1, 1) AND y.c = substr(pair, 2, 1))",
        ]
    ctes += [
        f"learned AS MATERIALIZED (SELECT word, n, s FROM w{merges})",
        f"tokens AS MATERIALIZED (SELECT (unicode(c) - 256)::INTEGER AS id, token, l, r, rank FROM t{merges})",
    ]
    return ",\n".join(ctes)


def encoded(name: str, texts: str, key: str) -> str:
    """CTE ``name(key, ids)`` over ``texts(key, text)``, with the words that ``bpe`` learned.

    ``<s>`` and ``</s>`` in a text stand for their ids 0 and 1, and what lies
    between them is split into words separately.
    """
    return f"""
{name}_parts AS (SELECT {key}, string_split_regex(text, '<s>|</s>') AS gaps,
                        regexp_extract_all(text, '<s>|</s>') AS marks FROM ({texts})),
{name}_gaps AS (SELECT {key}, unnest(range(1, len(gaps) + 1)) AS part, unnest(gaps) AS gap FROM {name}_parts),
{name}_words AS (SELECT {key}, part, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM
                 (SELECT {key}, part, {word_list('gap')} AS words FROM {name}_gaps)),
{name}_flat AS (
  SELECT {key}, part, pos, p, unicode(substr(s, p, 1)) - 256 AS id FROM
    (SELECT {key}, part, pos, s, unnest(range(1, length(s) + 1)) AS p
     FROM {name}_words JOIN learned USING (word))
  UNION ALL
  SELECT {key}, part, 1000000000, 1, CASE mark WHEN '<s>' THEN 0 ELSE 1 END FROM
    (SELECT {key}, unnest(range(1, len(marks) + 1)) AS part, unnest(marks) AS mark FROM {name}_parts)),
{name} AS (SELECT {key}, list(id ORDER BY part, pos, p) AS ids FROM {name}_flat GROUP BY {key})"""


def causal(ids: str, n: int, pad_id: int) -> str:
    """Select list: padded ids, mask and labels."""
    head = f"list_slice({ids}, 1, {n})"
    short = f"greatest({n} - len({head}), 0)"
    filled = f"list_concat({head}, list_transform(range({short}), lambda i: {pad_id}))"
    mask = f"list_concat(list_transform({head}, lambda x: 1), list_transform(range({short}), lambda i: 0))"
    labels = f"list_transform({filled}, lambda x: CASE WHEN x = {pad_id} THEN -100 ELSE x END)"
    return (
        f"{numbers(filled)} AS input_ids, {numbers(mask)} AS attention_mask, {numbers(labels)} AS labels"
    )


DOCUMENT_PAIRS = f"""
model AS MATERIALIZED (SELECT prev, next, n, sum(n) OVER (PARTITION BY prev)::BIGINT AS prev_n FROM
          (SELECT prev, next, count(*) AS n FROM ({byte_pairs('SELECT text FROM documents')}) GROUP BY 1, 2))"""

CONTEXTS = f"""
contexts AS MATERIALIZED (SELECT item_id * 1000000 + pos AS context_id, {byte_list('word')} AS ids FROM
  (SELECT item_id, unnest(range(len(words))) AS pos, unnest(words) AS word FROM
    (SELECT item_id, string_split(text, ' ') AS words FROM benchmark)) WHERE word <> '')"""

SCORES = f"""{DOCUMENT_PAIRS},{CONTEXTS},
scores AS MATERIALIZED (SELECT context_id, next AS token_id, ln(n) AS score FROM contexts
           JOIN model ON prev = ids[-1])"""


def softmax(source: str, temperature: float) -> str:
    e = f"exp((score - max(score) OVER (PARTITION BY context_id)) / {temperature})"
    return (
        "SELECT context_id, token_id, score, e / sum(e) OVER (PARTITION BY context_id) AS prob FROM "
        f"(SELECT *, {e} AS e FROM {source})"
    )


def rescaled(source: str) -> str:
    return (
        "SELECT context_id, token_id, prob / sum(prob) OVER (PARTITION BY context_id) AS prob "
        f"FROM {source}"
    )


def best(source: str, k: int) -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY context_id ORDER BY score DESC, token_id) <= {k}"
    )


def nucleus(source: str, p: float) -> str:
    before = (
        "coalesce(sum(prob) OVER (PARTITION BY context_id ORDER BY prob DESC, token_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    return (
        f"SELECT context_id, token_id, prob FROM (SELECT *, {before} AS before FROM {source}) "
        f"WHERE before < {p} OR before = 0"
    )


def drawn(source: str, seed: int) -> str:
    u = f"('0x' || substr(md5('{seed}:' || context_id), 1, 8))::BIGINT / 4294967296.0"
    upto = (
        "sum(prob) OVER (PARTITION BY context_id ORDER BY prob DESC, token_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    return (
        "SELECT context_id, token_id FROM (SELECT *, max(upto) OVER (PARTITION BY context_id) AS total "
        f"FROM (SELECT *, {upto} AS upto FROM {source})) WHERE upto > ({u}) * total "
        "QUALIFY row_number() OVER (PARTITION BY context_id ORDER BY upto, token_id) = 1"
    )


ALLOWED = """
history AS (SELECT context_id, ids, unnest(range(1, len(ids))) AS i FROM contexts),
banned AS (SELECT DISTINCT context_id, ids[i + 1] AS token_id FROM history WHERE ids[i] = ids[-1]),
allowed AS (SELECT * FROM scores s WHERE NOT EXISTS
            (SELECT 1 FROM banned b WHERE b.context_id = s.context_id AND b.token_id = s.token_id))"""


def scored(name: str, sequences: str, key: str, model: str, alpha: float, vocab_size: int) -> str:
    """CTE ``name(key, n_pairs, log_prob)`` of ``sequences(key, text)`` over byte pairs."""
    return f"""
{name}_pairs AS ({byte_pairs(sequences, key)}),
{name}_totals AS (SELECT DISTINCT prev, prev_n FROM {model}),
{name} AS (SELECT {key}, count(*) AS n_pairs,
             sum(ln((coalesce(m.n, 0) + {alpha}) / (coalesce(t.prev_n, 0) + {alpha} * {vocab_size}))) AS log_prob
           FROM {name}_pairs q LEFT JOIN {model} m ON q.prev = m.prev AND q.next = m.next
           LEFT JOIN {name}_totals t ON q.prev = t.prev GROUP BY {key})"""


def epoch_rows(source: str, key: str, epochs: int, seed: int) -> str:
    return (
        f"SELECT epoch::INTEGER AS epoch, {key} AS key, row_number() OVER (PARTITION BY epoch "
        f"ORDER BY md5('{seed}:' || epoch || ':' || {key}), {key}) - 1 AS pos "
        f"FROM {source}, range({epochs}) AS e(epoch)"
    )


def batch_rows(source: str, batch: int, accum: int, world: int) -> str:
    return (
        f"SELECT epoch, key, pos, ((pos // {batch}) % {world})::INTEGER AS rank, "
        f"(pos // {batch}) // {world} AS micro, ((pos // {batch}) // {world}) // {accum} AS step "
        f"FROM ({source})"
    )
