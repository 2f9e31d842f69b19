"""DuckDB SQL that states each registered query's result."""

from __future__ import annotations

from catalog.spark_queries import (
    DATA_FRACTION,
    MAX_TRAIN_DOCS,
    MAX_VAL_DOCS,
    PART_TURNS,
    SYSTEM_TEXT,
)
from catalog.views import BLANKS, TOKENIZER_WORDS
from loomline.functions.text import SPACE_CLASS
from loomline.operators.chat import ERROR_PREFIX, GREETINGS

NAME = "Assistant"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '\A[{SPACE_CLASS}]+|[{SPACE_CLASS}]+\z', '', 'g')"


# ---- shared tables -------------------------------------------------------------------

RAW = """
raw AS (
  SELECT doc_id, line, line_no,
         coalesce(sum(octet_length(encode(line)) + 1) OVER (
           PARTITION BY doc_id ORDER BY line_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_offset
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts)))::INT AS line_no
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)))"""

LINES = f"""{RAW},
lines AS (
  SELECT doc_id, line_no, byte_offset, {strip('line')} AS text
  FROM raw WHERE {strip('line')} <> '')"""

SPLIT = f"""{LINES},
placed AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS ord, count(*) OVER () AS n
  FROM lines),
cut AS (
  SELECT *, n - greatest(1, floor(0.05::DOUBLE * n)::BIGINT) AS n_train FROM placed),
split_lines AS (
  SELECT doc_id, line_no, text, ord, n, n_train,
         CASE WHEN ord >= n_train THEN 'val' ELSE 'train' END AS split,
         CASE WHEN ord >= n_train THEN ord - n_train ELSE ord END AS split_ord,
         CASE WHEN ord >= n_train THEN n - n_train ELSE n_train END AS n_split
  FROM cut)"""

VOCAB = f"""{SPLIT},
vocab AS (
  SELECT '[UNK]' AS token, 0 AS id UNION ALL SELECT '[BOS]', 1 UNION ALL SELECT '[EOS]', 2
  UNION ALL
  SELECT token, (row_number() OVER (ORDER BY c DESC, token) + 2)::INT
  FROM (SELECT token, count(*) AS c
        FROM (SELECT unnest(regexp_split_to_array(text, '[{SPACE_CLASS}]+')) AS token
              FROM split_lines WHERE split = 'train')
        GROUP BY token ORDER BY c DESC, token))"""

TOKENS = f"""{VOCAB},
words AS (
  SELECT doc_id, line_no, unnest(w) AS token, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, line_no, regexp_split_to_array(text, '[{SPACE_CLASS}]+') AS w
        FROM split_lines)),
encoded AS (
  SELECT doc_id, line_no, list(coalesce(id, 0) ORDER BY pos) AS ids
  FROM words LEFT JOIN vocab USING (token) GROUP BY doc_id, line_no),
wrapped AS (
  SELECT doc_id, line_no, [1] || ids || [2] AS ids FROM encoded)"""


def decoded(end: int = 2**31) -> str:
    return f"""WITH {TOKENS}
  SELECT doc_id, line_no,
         coalesce(string_agg(vocab.token, ' ' ORDER BY pos)
                  FILTER (vocab.id > 2 AND vocab.id < {end}), '') AS text
  FROM words LEFT JOIN vocab USING (token) GROUP BY doc_id, line_no"""


def known_to_file(ids: str) -> str:
    return f"list_transform({ids}, lambda i: CASE WHEN i < {TOKENIZER_WORDS + 3} THEN i ELSE 0 END)"


def draws(last: int) -> str:
    return f"""
draws AS (
  SELECT split, split_ord AS example, k,
         ('0x' || substr(md5('0|' || split || '|' || split_ord || '|' || k), 1, 15))::BIGINT
           % n_split AS split_ord
  FROM split_lines, range(0, {last + 1}) AS r(k))"""


PACKED = f"""{TOKENS},{draws(64)},
sized AS (
  SELECT split, split_ord, ids, len(ids) AS len
  FROM wrapped JOIN split_lines USING (doc_id, line_no)),
started AS (
  SELECT split, example, k, split_ord,
         coalesce(sum(len) OVER (PARTITION BY split, example ORDER BY k
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM draws JOIN (SELECT split, split_ord, len FROM sized) USING (split, split_ord)),
packed AS (
  SELECT split, example, flatten(list(ids ORDER BY k))[1:129] AS ids
  FROM started JOIN sized USING (split, split_ord) WHERE start < 129
  GROUP BY split, example)"""


def joined(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


LOSSES = """
losses AS (
  SELECT user_id % 4 AS run_id, 200 * (event_id // 60) AS step,
         CASE WHEN event_id % 60 < 30 THEN 'train' ELSE 'val' END AS split,
         value AS loss, ts
  FROM events),
means AS (
  SELECT run_id, step, avg(loss) FILTER (split = 'train') AS train_loss,
         avg(loss) FILTER (split = 'val') AS val_loss, max(ts) AS ts
  FROM losses GROUP BY run_id, step),
marked AS (
  SELECT *, min(val_loss) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS best_val,
         val_loss < coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY step
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'Infinity'::DOUBLE) AS is_best
  FROM means)"""


def rate(step: str, last: str) -> str:
    done = f"least(({step} - 100) / greatest({last} - 100, 1)::DOUBLE, 1.0)"
    return f"""CASE WHEN {step} < 100 THEN 1e-4::DOUBLE * ({step} + 1) / 100
      ELSE 1e-5::DOUBLE + 4.5e-5::DOUBLE * (1 + cos(pi() * {done})) END"""


EVAL_LOG = f"""{LOSSES},
log AS (
  SELECT run_id, step, round(train_loss, 9) AS train_loss, round(val_loss, 9) AS val_loss,
         round({rate('step', '(SELECT max(step) FROM losses)')}, 12) AS lr,
         round((epoch_us(ts) - (SELECT min(epoch_us(l.ts)) FROM losses l WHERE l.run_id = marked.run_id)) / 1e6, 6) AS elapsed_s,
         round(best_val, 9) AS best_val, is_best
  FROM marked WHERE step % 200 = 0)"""

THINK_TURNS = """
think_turns AS (
  SELECT conv_id, turn, role,
         CASE WHEN role <> 'assistant' THEN text
              WHEN turn % 4 = 1 THEN '<think>' || chr(10) || text || chr(10) || '</think> ' || text
                || ' <think>' || chr(10) || text || chr(10) || '</think>'
              ELSE '<think> ' || text || ' & "so" it''s <ok> </think>' || chr(10) || text
         END AS text
  FROM conversations)"""

THINK_SPLIT = f"""{THINK_TURNS},
blocks AS (
  SELECT *, CASE WHEN role = 'assistant' AND regexp_matches(text, '(?s)<think>(.*?)</think>')
                 THEN regexp_extract(text, '(?s)<think>(.*?)</think>') END AS block
  FROM think_turns),
thought AS (
  SELECT conv_id, turn, role,
         CASE WHEN block IS NOT NULL
              THEN {strip("regexp_extract(text, '(?s)<think>(.*?)</think>', 1)")} END AS reasoning,
         CASE WHEN block IS NULL THEN text
              ELSE {strip("replace(text, block, '')")} END AS answer
  FROM blocks)"""


def escaped(text: str) -> str:
    return (
        f"replace(replace(replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'),"
        " '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
    )


REPLY_TURNS = f"""
reply_turns AS (
  SELECT conv_id, turn, role,
         CASE WHEN role = 'assistant' AND (conv_id * 3 + turn) % 7 = 0
              THEN '{ERROR_PREFIX}' || text ELSE text END AS text
  FROM conversations)"""

PENDING = """
pending AS (
  SELECT conv_id, max(turn) AS last_turn FROM conversations
  GROUP BY conv_id HAVING arg_max(role, turn) = 'user')"""

SEGMENTS = """
actions AS (
  SELECT user_id, ts, event_id,
         CASE event_type WHEN 'signup' THEN 'new_chat' WHEN 'error' THEN 'clear'
           WHEN 'click' THEN 'yes' WHEN 'view' THEN 'cancel' WHEN 'purchase' THEN 'prompt'
         END AS action
  FROM events),
moved AS (
  SELECT *, last_value(CASE WHEN action <> 'new_chat' THEN action END IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
  FROM actions),
resets AS (
  SELECT *, action = 'new_chat' OR (action = 'yes' AND coalesce(prior = 'clear', false)) AS is_reset
  FROM moved),
numbered AS (
  SELECT *, count(*) FILTER (is_reset) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS UNBOUNDED PRECEDING) AS chat_seq
  FROM resets),
segments AS (
  SELECT *, sha256(user_id || '|' || chat_seq) AS chat_id FROM numbered)"""


def limited(train: str, val: str) -> str:
    return (
        f"WITH {SPLIT} SELECT doc_id, line_no, ord, split, split_ord FROM split_lines"
        f" WHERE split_ord < CASE WHEN split = 'train' THEN {train} ELSE {val} END"
    )


def part(text: str) -> str:
    return f"floor({DATA_FRACTION}::DOUBLE * {text})"


# Markup that must equal the chat page's.
_blanks = " || ".join(f"chr({c})" for c in BLANKS)
_shell = '<div class="chat-shell"><div class="chat-title">Conversation</div>'
_label = '<span class="message-label">'

ORACLE = {
    "corpus_lines": f"WITH {LINES} SELECT doc_id, line_no, byte_offset, text FROM lines",
    "corpus_stats": f"""WITH {LINES}
        SELECT (SELECT count(*) FROM documents) AS files, count(*) AS documents FROM lines""",
    "corpus_files": f"""WITH {LINES}
        SELECT text, count(*) AS copies FROM lines GROUP BY text""",
    "corpus_hidden": f"""WITH {LINES}
        SELECT text, count(*) AS copies, count(*) AS places FROM lines GROUP BY text""",
    "corpus_first_batch": f"""WITH {PACKED}
        SELECT split, example, {joined('ids')} AS ids FROM packed WHERE example < 64""",
    "corpus_positions": f"""WITH {LINES}
        SELECT count(*) AS documents, (count(*) * (count(*) - 1) // 2)::BIGINT AS ord_sum,
               count(*) AS places FROM lines""",
    "lossy_decode": """SELECT doc_id, chr(65533) || chr(65533) || text || chr(65533) AS text
        FROM documents""",
    "text_strip": f"SELECT doc_id, {strip(f'{_blanks} || text || {_blanks}')} AS text FROM documents",
    "doc_ordinals": f"WITH {SPLIT} SELECT doc_id, line_no, ord FROM split_lines",
    "split_docs": f"WITH {SPLIT} SELECT doc_id, line_no, ord, split, split_ord FROM split_lines",
    "split_fraction": limited(part("n_train"), part("(n - n_train)")),
    "split_caps": limited(str(MAX_TRAIN_DOCS), str(MAX_VAL_DOCS)),
    "split_counts": f"""WITH {SPLIT}
        SELECT count(*) FILTER (split = 'train') AS train_docs,
               count(*) FILTER (split = 'val') AS val_docs FROM split_lines""",
    "special_tokens": f"WITH {VOCAB} SELECT token, id FROM vocab WHERE token IN ('[BOS]', '[EOS]')",
    "vocab": f"WITH {VOCAB} SELECT token, id FROM vocab",
    "vocab_size": f"WITH {VOCAB} SELECT count(*) AS vocab_size FROM vocab",
    "encode_docs": f"WITH {TOKENS} SELECT doc_id, line_no, {joined('ids')} AS ids FROM encoded",
    "encode_docs_tokenizer": f"""WITH {TOKENS}
        SELECT doc_id, line_no, {joined(known_to_file('ids'))} AS ids FROM encoded""",
    "decode_docs": decoded(),
    "decode_docs_tokenizer": decoded(TOKENIZER_WORDS + 3),
    "wrapped_docs": f"WITH {TOKENS} SELECT doc_id, line_no, {joined('ids')} AS ids FROM wrapped",
    "context_window": f"""WITH {TOKENS}
        SELECT doc_id, line_no, {joined('ids[greatest(len(ids) - 127, 1):len(ids)]')} AS ids
        FROM wrapped""",
    "doc_draws": f"""WITH {SPLIT},{draws(64)}
        SELECT split, example, k::INT AS k, split_ord FROM draws""",
    "packed_examples": f"WITH {PACKED} SELECT split, example, {joined('ids')} AS ids FROM packed",
    "first_batch": f"""WITH {PACKED}
        SELECT split, example, {joined('ids')} AS ids FROM packed WHERE example < 64""",
    "shifted_pairs": f"""WITH {PACKED}
        SELECT split, example, {joined('ids[1:128]')} AS input_ids,
               {joined('ids[2:129]')} AS target_ids FROM packed""",
    "batches": f"""WITH {PACKED}
        SELECT split, example // 64 AS batch_id, (example % 64)::INT AS row_in_batch,
               {joined('ids[1:128]')} AS input_ids, {joined('ids[2:129]')} AS target_ids
        FROM packed""",
    "eval_means": f"""WITH {LOSSES}
        SELECT run_id, step, round(train_loss, 9) AS train_loss, round(val_loss, 9) AS val_loss
        FROM means""",
    "lr_schedule": f"""SELECT event_id AS step,
        round({rate('event_id', '(SELECT max(event_id) FROM events)')}, 12) AS lr FROM events""",
    "eval_steps": "SELECT event_id AS step, value AS loss FROM events WHERE event_id % 200 = 0",
    "best_steps": f"""WITH {LOSSES}
        SELECT run_id, step, round(best_val, 9) AS best_val, is_best FROM marked""",
    "eval_log": f"WITH {EVAL_LOG} SELECT * FROM log",
    "eval_log_written": f"WITH {EVAL_LOG} SELECT * FROM log",
    "run_summary": f"""WITH {EVAL_LOG}
        SELECT run_id, max(elapsed_s) AS total_s, min(val_loss) AS best_val
        FROM log GROUP BY run_id""",
    "think_split": f"WITH {THINK_SPLIT} SELECT conv_id, turn, role, reasoning, answer FROM thought",
    "escaped_texts": f"SELECT page_id, {escaped('html')} AS html FROM pages",
    "transcripts": f"""WITH {THINK_SPLIT},
        blocks_html AS (
          SELECT conv_id, turn, CASE WHEN role = 'assistant'
            THEN '<div class="message assistant-message">{_label}{NAME} reply</span>'
              || CASE WHEN reasoning IS NULL THEN '' ELSE '<details><summary>Reasoning</summary><div>'
                   || {escaped('reasoning')} || '</div></details>' END
              || '<div>' || {escaped('answer')} || '</div></div>'
            ELSE '<div class="message user-message">{_label}Your message</span><div>'
              || {escaped('answer')} || '</div></div>' END AS piece
          FROM thought)
        SELECT conv_id, turn // {PART_TURNS} AS part,
               CASE WHEN part = min(part) OVER (PARTITION BY conv_id) THEN '{_shell}' ELSE '' END
               || string_agg(piece, '' ORDER BY turn)
               || CASE WHEN part = max(part) OVER (PARTITION BY conv_id) THEN '</div>' ELSE '' END
                 AS html
        FROM blocks_html GROUP BY conv_id, turn // {PART_TURNS}""",
    "pending_chats": f"WITH {PENDING} SELECT conv_id, last_turn FROM pending",
    "error_replies": f"""WITH {REPLY_TURNS}
        SELECT turn, count(*) AS replies,
               count(*) FILTER (starts_with(text, '{ERROR_PREFIX}')) AS errors,
               round(count(*) FILTER (starts_with(text, '{ERROR_PREFIX}')) / count(*)::DOUBLE, 9)
                 AS error_rate
        FROM reply_turns WHERE role = 'assistant' GROUP BY turn""",
    "prompts": f"""WITH {THINK_TURNS}, {PENDING}
        SELECT conv_id, turn // {PART_TURNS} AS part,
               '[' || CASE WHEN part = min(part) OVER (PARTITION BY conv_id)
                 THEN to_json({{'role': 'system', 'content': '{SYSTEM_TEXT}'}}) || ',' ELSE '' END
               || string_agg(to_json({{'role': role, 'content': text}})::VARCHAR, ',' ORDER BY turn)
               || ']' AS prompt
        FROM think_turns JOIN pending USING (conv_id) GROUP BY conv_id, turn // {PART_TURNS}""",
    "append_turns": f"""WITH {PENDING}
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL
        SELECT conv_id, turn + 1, 'assistant', 'You asked: ' || text
        FROM conversations JOIN pending USING (conv_id) WHERE turn = last_turn
        UNION ALL
        SELECT conv_id, last_turn + 2, 'user', 'Thanks.' FROM pending WHERE conv_id % 2 = 0""",
    "chat_segments": f"""WITH {SEGMENTS}
        SELECT event_id, user_id, action, is_reset, chat_seq, chat_id FROM segments""",
    "seed_greetings": f"""WITH {SEGMENTS},
        opened AS (
          SELECT DISTINCT user_id, 0::BIGINT AS chat_seq, '{GREETINGS['first'].format(name=NAME)}' AS text
          FROM events
          UNION ALL
          SELECT user_id, chat_seq, CASE WHEN action = 'new_chat'
            THEN '{GREETINGS['new_chat'].format(name=NAME)}' ELSE '{GREETINGS['cleared']}' END
          FROM segments WHERE is_reset)
        SELECT user_id, chat_seq, sha256(user_id || '|' || chat_seq) AS chat_id, 0 AS turn,
               'assistant' AS role, text FROM opened""",
}
