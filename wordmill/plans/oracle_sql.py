"""DuckDB statements that restate each registered query independently.

They run on the driver's views (``documents``, ``conversations``,
``benchmark``, ``part``, ``embeddings``, ...).  Shared pieces are assembled
from the same fixed values the Spark side uses.
"""

from __future__ import annotations

from wordmill.constants import (
    DEFAULT_STOPWORDS,
    END_TOKEN,
    OWNER_LABEL,
    PAD_TOKEN,
    PUNCTUATION_TAGS,
    RARE_WORD_CUT,
    RUN_PATTERN,
    SG_BATCH,
    SG_NEGATIVES,
    SG_SIZE,
    SG_WINDOW,
    SUBSAMPLE_T,
    SUBSAMPLE_TH,
    START_TOKEN,
    TECHNICIAN_LABEL,
    TOKEN_PATTERN,
    UNK_TOKEN,
    WV_MIN_COUNT,
    WV_SIZE,
    clean_pattern,
)
from wordmill.operators.negatives import BLOCKS, UNIT

#: Length of the vectors by factorisation.
PPMI_SIZE = 32


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SW_LIST = "[" + ", ".join(q(w) for w in sorted(set(DEFAULT_STOPWORDS))) + "]"
SW_IN = "(" + ", ".join(q(w) for w in sorted(set(DEFAULT_STOPWORDS))) + ")"
TOK = q(TOKEN_PATTERN)
CLEAN = q(clean_pattern())


def f1(expr: str) -> str:
    out = f"lower({expr})"
    for mark, tag in PUNCTUATION_TAGS:
        out = f"replace({out}, {q(mark)}, {q(tag)})"
    return out


def clean(expr: str, gap: str = "") -> str:
    return f"regexp_replace(coalesce({expr}, ''), {CLEAN}, {q(gap)}, 'g')"


def sentence_proc(expr: str) -> str:
    return (
        f"array_to_string(list_filter(regexp_extract_all({clean(expr, ' ')}, {q(RUN_PATTERN)}), "
        f"lambda x: NOT list_contains({SW_LIST}, x)), ' ')"
    )


def strip_ws(expr: str) -> str:
    ws = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    return f"regexp_replace({expr}, {q('^' + ws + '|' + ws + '$')}, '', 'g')"


LABEL = f"(CASE role WHEN 'user' THEN {q(OWNER_LABEL)} WHEN 'assistant' THEN {q(TECHNICIAN_LABEL)} ELSE '' END)"
# Train file = records with a Report (a benchmark row); the rest is the test file.
FNO = "(CASE WHEN {k} IN (SELECT item_id FROM benchmark) THEN 0 ELSE 1 END)"

CELLS = f"""
cells_raw AS (
  SELECT doc_id AS row_id, 0 AS col_no, 0::BIGINT AS sub, text, false AS special FROM documents
  UNION ALL
  SELECT conv_id, 1, turn, {LABEL} || text, false FROM conversations
  UNION ALL
  SELECT item_id, 2, 0, text, false FROM benchmark
  UNION ALL
  SELECT p_partkey, 3, 0, p_brand, true FROM part
  UNION ALL
  SELECT p_partkey, 4, 0, p_type, true FROM part
),
cells AS (
  SELECT {FNO.format(k='row_id')} AS file_no, row_id, col_no, sub, text, special FROM cells_raw
)"""

TEXT_TOKENS = f"""
ttok_src AS (
  SELECT file_no, row_id, col_no, sub, regexp_extract_all(replace({f1('text')}, '|', ' '), {TOK}) AS t
  FROM cells WHERE NOT special AND text IS NOT NULL
),
ttok AS (
  SELECT file_no, row_id, col_no, sub, (generate_subscripts(t, 1) - 1)::BIGINT AS pos, unnest(t) AS token FROM ttok_src
)"""

ALL_TOKENS = f"""
tok AS (
  SELECT * FROM ttok
  UNION ALL
  SELECT file_no, row_id, col_no, sub, 0::BIGINT, text FROM cells WHERE special AND text IS NOT NULL
)"""

VOCAB_ALL = f"""
vfirst AS (
  SELECT token AS word, count(*) OVER (PARTITION BY token) AS freq,
         row_number() OVER (PARTITION BY token ORDER BY file_no, row_id, col_no, sub, pos) AS rn,
         file_no, row_id, col_no, sub, pos
  FROM tok
),
vocab_all AS (
  SELECT word, (row_number() OVER (ORDER BY file_no, row_id, col_no, sub, pos) - 1)::BIGINT AS idx, freq
  FROM vfirst WHERE rn = 1 AND word <> chr(9) AND word NOT IN {SW_IN}
),
vocab AS (SELECT * FROM vocab_all WHERE freq >= {RARE_WORD_CUT})"""

DIALOGUES = f"""
dlg AS (
  SELECT conv_id AS row_id, string_agg({LABEL} || text, '|' ORDER BY turn) AS Dialogue FROM conversations GROUP BY conv_id
)"""

QA = f"""
qa AS (
  SELECT {FNO.format(k='k.row_id')} AS file_no,
         CASE WHEN {FNO.format(k='k.row_id')} = 0 THEN 'train' ELSE 'test' END AS split,
         k.row_id, p.p_brand AS Brand, p.p_type AS Model, d.text AS Question, g.Dialogue, b.text AS Report
  FROM (SELECT doc_id AS row_id FROM documents UNION SELECT conv_id FROM conversations
        UNION SELECT item_id FROM benchmark UNION SELECT p_partkey FROM part) k
  LEFT JOIN documents d ON d.doc_id = k.row_id
  LEFT JOIN dlg g ON g.row_id = k.row_id
  LEFT JOIN benchmark b ON b.item_id = k.row_id
  LEFT JOIN part p ON p.p_partkey = k.row_id
)"""

SEG = f"""
seg AS (
  SELECT file_no, split, row_id,
         {sentence_proc('Brand')} AS Brand, {sentence_proc('Model')} AS Model,
         {sentence_proc('Question')} AS Question, {sentence_proc('Dialogue')} AS Dialogue,
         CASE WHEN file_no = 0 THEN {sentence_proc('Report')} END AS Report
  FROM qa
)"""

# X / Y line corpora built from the segmented table (P9): X = Question + Dialogue, Y = Report.
XY = """
xy AS (
  SELECT file_no, split, row_id, 'x' AS kind, coalesce(Question, '') || ' ' || coalesce(Dialogue, '') AS s FROM seg
  UNION ALL
  SELECT file_no, split, row_id, 'y', coalesce(Report, '') FROM seg WHERE file_no = 0
)"""

LENS = f"""
lens AS (
  SELECT split || kind AS corpus, trunc(avg(n) + 2 * stddev_pop(n))::BIGINT AS max_len FROM (
    SELECT split, kind, length(s) - length(replace(s, ' ', '')) + 1 AS n FROM xy) GROUP BY split, kind
),
caps AS (
  SELECT 'x' AS kind, max(max_len) AS cap FROM lens WHERE corpus IN ('trainx', 'testx')
  UNION ALL SELECT 'y', max(max_len) FROM lens WHERE corpus = 'trainy'
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["vocab_build"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL) + "SELECT word, idx, freq FROM vocab"

ORACLE["vocab_special_columns"] = with_(CELLS) + (
    "SELECT text AS token, count(*) AS freq FROM cells WHERE special AND text IS NOT NULL GROUP BY text"
)

ORACLE["mark_punctuation"] = f"SELECT doc_id, replace({f1('text')}, '|', ' ') AS text FROM documents"

ORACLE["clean_sentence"] = f"SELECT doc_id, {clean('text')} AS text FROM documents"

ORACLE["dialogue_clean"] = with_(DIALOGUES) + f"SELECT row_id AS conv_id, {sentence_proc('Dialogue')} AS text FROM dlg"

ORACLE["segmented_table"] = with_(DIALOGUES, QA, SEG) + "SELECT split, row_id, Brand, Model, Question, Dialogue, Report FROM seg"

ORACLE["training_corpus"] = with_(DIALOGUES, QA, SEG) + (
    "SELECT split, row_id, CASE WHEN file_no = 0 "
    "THEN coalesce(Question, '') || ' ' || coalesce(Dialogue, '') || ' ' || coalesce(Report, '') "
    "ELSE coalesce(Question, '') || ' ' || coalesce(Dialogue, '') END AS merged FROM seg"
)

ORACLE["max_len"] = with_(DIALOGUES, QA, SEG, XY, LENS) + (
    "SELECT corpus, max_len FROM lens UNION ALL SELECT kind, cap FROM caps"
)

PADDED = f"""
ptok_src AS (
  SELECT x.file_no, x.split, x.row_id, x.kind, c.cap, string_split({strip_ws('x.s')}, ' ')[1:c.cap] AS t
  FROM xy x JOIN caps c ON c.kind = x.kind
),
ptok AS (SELECT file_no, split, row_id, kind, cap, generate_subscripts(t, 1) AS pos, unnest(t) AS token FROM ptok_src),
top AS (SELECT coalesce(max(idx), -1) AS m FROM vocab),
prow AS (
  SELECT p.file_no, p.split, p.row_id, p.kind, p.cap, count(*) AS n,
         string_agg(CASE WHEN v.idx IS NULL THEN {q(UNK_TOKEN)} ELSE p.token END, ' ' ORDER BY p.pos) AS body,
         string_agg(coalesce(v.idx, (SELECT m FROM top) + 4)::VARCHAR, ' ' ORDER BY p.pos) AS body_ids
  FROM ptok p LEFT JOIN vocab v ON v.word = p.token
  GROUP BY p.file_no, p.split, p.row_id, p.kind, p.cap
),
padded AS (
  SELECT file_no, split, row_id, kind,
         {q(START_TOKEN + ' ')} || body || {q(' ' + END_TOKEN)} || repeat({q(' ' + PAD_TOKEN)}, (cap - n)::INTEGER) AS seq,
         ((SELECT m FROM top) + 2)::VARCHAR || ' ' || body_ids || ' ' || ((SELECT m FROM top) + 3)::VARCHAR
           || repeat(' ' || ((SELECT m FROM top) + 1)::VARCHAR, (cap - n)::INTEGER) AS ids
  FROM prow
)"""

_E2_VOCAB = (CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, DIALOGUES, QA, SEG, XY, LENS, PADDED)

ORACLE["pad_sequences"] = with_(*_E2_VOCAB) + "SELECT split, row_id, kind, seq FROM padded"

ORACLE["model_inputs"] = with_(*_E2_VOCAB) + (
    "SELECT split, row_id, kind, ((row_number() OVER (PARTITION BY file_no, kind ORDER BY row_id) - 1) // 100)::BIGINT AS batch, "
    "ids FROM padded"
)

ORACLE["corpus_tokens"] = with_(CELLS, TEXT_TOKENS) + "SELECT file_no, row_id, col_no, sub, pos, token FROM ttok"

ENCODED = f"""
enc AS (
  SELECT t.file_no, t.row_id, t.col_no, t.sub, t.pos, v.idx FROM ttok t JOIN vocab v ON v.word = t.token
  WHERE t.token NOT IN {SW_IN}
)"""

ORACLE["encode"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, ENCODED) + (
    "SELECT file_no, row_id, col_no, sub, pos, idx FROM enc"
)

ORACLE["decode"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, ENCODED) + (
    "SELECT e.file_no, e.row_id, e.col_no, e.sub, e.pos, v.word FROM enc e JOIN vocab v ON v.idx = e.idx"
)

SKIPGRAM = f"""
sfreq AS (SELECT idx, count(*) AS n FROM enc GROUP BY idx),
stot AS (SELECT count(*) AS total FROM enc),
rfreq AS (
  SELECT idx, n, n / (SELECT total FROM stot) AS freq, 1 - sqrt({SUBSAMPLE_T} / (n / (SELECT total FROM stot))) AS p_drop FROM sfreq
),
kept AS (SELECT e.* FROM enc e JOIN rfreq f ON f.idx = e.idx WHERE f.p_drop < {SUBSAMPLE_TH}),
gpos AS (SELECT (row_number() OVER (ORDER BY file_no, row_id, col_no, sub, pos) - 1)::BIGINT AS gidx, idx FROM kept),
nb AS (SELECT (count(*) // {SG_BATCH}) * {SG_BATCH} AS lim FROM gpos),
bat AS (
  SELECT (gidx // {SG_BATCH})::BIGINT AS batch, gidx, idx,
         1 + ((((gidx % 2147483648) * 1103515245 + 12345) % 2147483648) // 65536) % {SG_WINDOW} AS r
  FROM gpos WHERE gidx < (SELECT lim FROM nb)
)"""


def context_sql(reach: str) -> str:
    return f"""
ctxp AS (
  SELECT a.batch, a.gidx, a.idx AS center, b.idx AS context
  FROM bat a JOIN bat b ON a.batch = b.batch AND b.gidx <> a.gidx AND abs(b.gidx - a.gidx) <= {reach}
  GROUP BY a.batch, a.gidx, a.idx, b.idx
)"""


_SG = (CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, ENCODED, SKIPGRAM)

ORACLE["relative_frequency"] = with_(*_SG) + "SELECT idx, n, round(freq, 6) AS freq, round(p_drop, 6) AS p_drop FROM rfreq"

ORACLE["subsample"] = with_(*_SG) + "SELECT file_no, row_id, col_no, sub, pos, idx FROM kept"

ORACLE["global_position"] = with_(*_SG) + "SELECT gidx, idx FROM gpos"

ORACLE["full_batches"] = with_(*_SG) + "SELECT batch, count(*) AS n, sum(idx)::BIGINT AS idx_sum FROM bat GROUP BY batch"

ORACLE["context_fixed"] = with_(*_SG, context_sql(str(SG_WINDOW))) + (
    "SELECT batch, gidx, center, array_to_string(list_sort(list(context)), ' ') AS context FROM ctxp GROUP BY batch, gidx, center"
)

ORACLE["context_random"] = with_(*_SG, context_sql("a.r")) + (
    "SELECT batch, gidx, center, array_to_string(list_sort(list(context)), ' ') AS context FROM ctxp GROUP BY batch, gidx, center"
)

ORACLE["skipgram_pairs"] = with_(*_SG, context_sql("a.r")) + (
    "SELECT batch, center, context, count(*) AS n FROM ctxp GROUP BY batch, center, context"
)

COOC = """
cooc AS (SELECT center AS w, context AS c, count(*) AS n FROM ctxp GROUP BY center, context),
ctot AS (SELECT sum(n) AS total FROM cooc),
cw AS (SELECT w, sum(n) AS n_w FROM cooc GROUP BY w),
cc AS (SELECT c, sum(n) AS n_c FROM cooc GROUP BY c)"""

ORACLE["cooccurrence"] = with_(*_SG, context_sql("a.r"), COOC) + "SELECT w, c, n FROM cooc"

# counts add up over batches, so the extended table is the whole corpus's
ORACLE["extend_cooccurrence"] = ORACLE["cooccurrence"]

ORACLE["skipgram_pair_rows"] = with_(*_SG, context_sql("a.r")) + "SELECT batch, gidx, center, context FROM ctxp"

ORACLE["ppmi"] = with_(*_SG, context_sql("a.r"), COOC) + (
    "SELECT o.w, o.c, o.n, round(ln(o.n::DOUBLE * (SELECT total FROM ctot) / (cw.n_w::DOUBLE * cc.n_c)), 6) AS pmi, "
    "round(greatest(ln(o.n::DOUBLE * (SELECT total FROM ctot) / (cw.n_w::DOUBLE * cc.n_c)), 0.0), 6) AS ppmi "
    "FROM cooc o JOIN cw ON cw.w = o.w JOIN cc ON cc.c = o.c"
)

# Whitespace token lines (S9) of the merged corpus and of the padded corpora.
WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
LINES = f"""
mlines AS (
  SELECT row_id, CASE WHEN file_no = 0
    THEN coalesce(Question, '') || ' ' || coalesce(Dialogue, '') || ' ' || coalesce(Report, '')
    ELSE coalesce(Question, '') || ' ' || coalesce(Dialogue, '') END AS line FROM seg
),
mtok AS (SELECT unnest(list_filter(regexp_split_to_array(line, {q(WS)}), lambda t: t <> '')) AS w FROM mlines),
w2v_vocab AS (SELECT w AS word FROM mtok GROUP BY w HAVING count(*) >= {WV_MIN_COUNT})"""

ORACLE["train_embeddings"] = with_(DIALOGUES, QA, SEG, LINES) + f"SELECT word, {WV_SIZE}::BIGINT AS dims, true AS sound FROM w2v_vocab"

ORACLE["skipgram_embeddings"] = with_(*_SG) + f"SELECT DISTINCT idx::VARCHAR AS word, {SG_SIZE}::BIGINT AS dims, true AS sound FROM bat"

ORACLE["extend_embeddings"] = with_(*_E2_VOCAB, LINES) + (
    f", ptoks AS (SELECT w FROM mtok UNION ALL "
    f"SELECT unnest(list_filter(regexp_split_to_array(seq, {q(WS)}), lambda t: t <> '')) FROM padded) "
    f"SELECT w AS word, {WV_SIZE}::BIGINT AS dims, true AS sound FROM ptoks GROUP BY w HAVING count(*) >= {WV_MIN_COUNT}"
)

ORACLE["lookup_vectors"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, DIALOGUES, QA, SEG, LINES) + (
    f"SELECT DISTINCT a.word, {WV_SIZE}::BIGINT AS dims, true AS sound FROM vocab_all a JOIN w2v_vocab w ON w.word = a.word"
)

ORACLE["embedding_matrix"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL) + (
    ", wv AS (SELECT a.word, e.embedding FROM embeddings e JOIN vocab_all a ON a.idx = e.vec_id), "
    "m AS (SELECT v.idx, wv.embedding FROM vocab v JOIN wv ON wv.word = v.word) "
    "SELECT idx, (generate_subscripts(embedding, 1) - 1)::BIGINT AS dim, round(unnest(embedding)::DOUBLE, 6) AS value FROM m"
)

ORACLE["corpus_stats"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, DIALOGUES, QA, SEG, LINES) + (
    "SELECT (SELECT count(*) FROM mlines) AS corpus_count, (SELECT count(DISTINCT word) FROM vocab) AS vocab_size, "
    "(SELECT count(*) FROM w2v_vocab) AS min_count_vocab"
)

# Content of an artifact: each line or word weighed by its place.
_DIGEST = "sum(('0x' || substr(md5(word), 1, 8))::BIGINT::DECIMAL(38, 0) * (idx % 1000 + 1))::DECIMAL(38, 0)::VARCHAR"

ORACLE["io_roundtrip"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, DIALOGUES, QA, SEG) + (
    ", wv AS (SELECT a.word, e.embedding FROM embeddings e JOIN vocab_all a ON a.idx = e.vec_id), "
    "vlines AS (SELECT row_number() OVER (ORDER BY idx) - 1 AS idx, replace(replace(replace(replace(word, chr(92), chr(92) || chr(92)), "
    "chr(9), chr(92) || 't'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r') || chr(9) || idx || chr(9) || freq AS word FROM vocab), "
    "mrows AS (SELECT row_number() OVER (ORDER BY v.idx) - 1 AS idx, v.idx::VARCHAR AS word, wv.embedding FROM vocab v JOIN wv ON wv.word = v.word), "
    "mlines AS (SELECT idx, word FROM mrows), "
    "mvalues AS (SELECT idx * 64 + dim AS idx, round(value * 1e6)::BIGINT::VARCHAR AS word FROM ("
    "SELECT idx, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS value FROM mrows)), "
    "lines AS (SELECT (row_number() OVER (ORDER BY file_no, row_id) - 1)::BIGINT AS idx, CASE WHEN file_no = 0 "
    "THEN coalesce(Question, '') || ' ' || coalesce(Dialogue, '') || ' ' || coalesce(Report, '') "
    "ELSE coalesce(Question, '') || ' ' || coalesce(Dialogue, '') END AS word FROM seg) "
    f"SELECT 'vocab_word_to_idx' AS artifact, count(*) AS n, {_DIGEST} AS digest FROM vocab "
    f"UNION ALL SELECT 'vocab_idx_to_word', count(*), {_DIGEST} FROM vocab "
    f"UNION ALL SELECT 'vocab_lines', count(*), {_DIGEST} FROM vlines "
    "UNION ALL SELECT 'segmented_csv', count(*), NULL FROM seg "
    f"UNION ALL SELECT 'merged_lines', count(*), {_DIGEST} FROM lines "
    f"UNION ALL SELECT 'matrix_lines', count(*), {_DIGEST} FROM mlines "
    f"UNION ALL SELECT 'matrix_values', count(*), {_DIGEST} FROM mvalues "
    f"UNION ALL SELECT 'stopwords', count(*), {_DIGEST} FROM (SELECT unnest({SW_LIST}) AS word, 0 AS idx)"
)

# R1 dictionary mode: the lattice of every distinct run, its best path from the end back
# (ties: the longer word, then the dictionary's), then the path's pieces from the start.
# ``dr`` holds the distinct runs; ``seg_tok`` their tokens in order.
DICTIONARY_PATHS = """
dic AS (SELECT word, freq::DOUBLE AS freq FROM vocab),
tot AS (SELECT ln(sum(freq)) AS lt, max(length(word)) AS ml FROM dic),
starts AS (SELECT run, n, unnest(range(0, n)) AS s FROM dr),
cand AS (SELECT run, s, unnest(range(1, least((SELECT ml FROM tot), n - s) + 1)) AS l FROM starts),
edges AS (
  SELECT c.run, c.s, c.l, ln(d.freq) - (SELECT lt FROM tot) AS lp, true AS k
  FROM cand c JOIN dic d ON d.word = substring(c.run, c.s + 1, c.l)
  UNION ALL SELECT run, s, 1, -(SELECT lt FROM tot), false FROM starts),
bwd AS (
  SELECT run, n AS i, [0.0::DOUBLE] AS best, []::STRUCT(l BIGINT, k BOOLEAN)[] AS ch FROM dr
  UNION ALL
  SELECT run, i - 1, list_prepend(t.sc, best), list_prepend(struct_pack(l := t.l, k := t.k), ch) FROM (
    SELECT b.run, b.i, b.best, b.ch, max(struct_pack(sc := e.lp + b.best[e.l], l := e.l, k := e.k)) AS t
    FROM bwd b JOIN edges e ON e.run = b.run AND e.s = b.i - 1 GROUP BY b.run, b.i, b.best, b.ch)),
path AS (
  SELECT run, 0::BIGINT AS pos, ch, ch[1].l AS l, ch[1].k AS k FROM bwd WHERE i = 0
  UNION ALL
  SELECT run, pos + l, ch, ch[pos + l + 1].l, ch[pos + l + 1].k FROM path WHERE pos + l < length(run)),
piece AS (
  SELECT run, pos, substring(run, pos + 1, l) AS p, NOT k AND regexp_matches(substring(run, pos + 1, l), '^[0-9A-Za-z]$') AS loose FROM path),
mark AS (
  SELECT *, CASE WHEN loose AND lag(loose, 1, false) OVER (PARTITION BY run ORDER BY pos) THEN 0 ELSE 1 END AS new FROM piece),
tokd AS (SELECT *, sum(new) OVER (PARTITION BY run ORDER BY pos) - 1 AS g FROM mark),
seg_tok AS (SELECT run, g, string_agg(p, '' ORDER BY pos) AS token FROM tokd GROUP BY run, g)"""


def with_recursive(*parts: str) -> str:
    return with_(*parts).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLE["segment_dictionary"] = with_recursive(
    CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL,
    f"""
runs_src AS (SELECT doc_id, regexp_extract_all(replace({f1('text')}, '|', ' '), {TOK}) AS t FROM documents),
runs AS (SELECT doc_id, generate_subscripts(t, 1) - 1 AS run_no, unnest(t) AS run FROM runs_src),
dr AS (SELECT DISTINCT run, length(run) AS n FROM runs)""",
    DICTIONARY_PATHS,
) + "SELECT r.doc_id, r.run_no::INTEGER AS run_no, s.g::INTEGER AS k, s.token FROM runs r JOIN seg_tok s ON s.run = r.run"

# F14, A3 in dictionary mode: the runs of all text cells, segmented by the vocabulary of the other mode.
_DICTIONARY_TOKENS = (
    CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL,
    "\ndr AS (SELECT DISTINCT token AS run, length(token) AS n FROM ttok)",
    DICTIONARY_PATHS,
    """
dtok AS (
  SELECT t.file_no, t.row_id, t.col_no, t.sub, s.token,
         (row_number() OVER (PARTITION BY t.file_no, t.row_id, t.col_no, t.sub ORDER BY t.pos, s.g) - 1)::BIGINT AS pos
  FROM ttok t JOIN seg_tok s ON s.run = t.token)""",
)

ORACLE["dictionary_tokens"] = with_recursive(*_DICTIONARY_TOKENS) + "SELECT file_no, row_id, col_no, sub, pos, token FROM dtok"

_SECOND = VOCAB_ALL.replace("vfirst", "dfirst").replace("vocab_all", "dvocab_all").replace("vocab AS", "dvocab AS").replace("FROM tok", "FROM dall")

ORACLE["dictionary_vocab"] = with_recursive(
    *_DICTIONARY_TOKENS,
    """
dall AS (
  SELECT file_no, row_id, col_no, sub, pos, token FROM dtok
  UNION ALL
  SELECT file_no, row_id, col_no, sub, 0::BIGINT, text FROM cells WHERE special AND text IS NOT NULL)""",
    _SECOND,
) + "SELECT word, idx, freq FROM dvocab"

# F6, F7 in dictionary mode: words of the cleaned cells of the wide table.
_QA_COLUMNS = ["Brand", "Model", "Question", "Dialogue", "Report"]

ORACLE["dictionary_corpus"] = with_recursive(
    CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, DIALOGUES, QA,
    "\nclean_src AS (" + " UNION ALL ".join(
        f"SELECT file_no, row_id, {q(c)} AS c, regexp_extract_all({clean(c, ' ')}, {q(RUN_PATTERN)}) AS t FROM qa" for c in _QA_COLUMNS
    ) + ")",
    """
clean_runs AS (SELECT file_no, row_id, c, generate_subscripts(t, 1) AS run_no, unnest(t) AS run FROM clean_src),
dr AS (SELECT DISTINCT run, length(run) AS n FROM clean_runs)""",
    DICTIONARY_PATHS,
    f"""
dcell AS (
  SELECT file_no, row_id, c, string_agg(s.token, ' ' ORDER BY r.run_no, s.g) AS t
  FROM clean_runs r JOIN seg_tok s ON s.run = r.run WHERE s.token NOT IN {SW_IN} GROUP BY file_no, row_id, c),
dwide AS (
  SELECT file_no, row_id, {", ".join(f"coalesce(max(t) FILTER (WHERE c = {q(c)}), '') AS {c}" for c in _QA_COLUMNS)}
  FROM dcell GROUP BY file_no, row_id)""",
) + (
    "SELECT qa.split, qa.row_id, CASE WHEN qa.file_no = 0 "
    "THEN coalesce(d.Question, '') || ' ' || coalesce(d.Dialogue, '') || ' ' || coalesce(d.Report, '') "
    "ELSE coalesce(d.Question, '') || ' ' || coalesce(d.Dialogue, '') END AS merged "
    "FROM qa LEFT JOIN dwide d ON d.file_no = qa.file_no AND d.row_id = qa.row_id"
)

# A cell that equals a null marker comes back empty; the driver tables hold none.
ORACLE["csv_splits"] = with_(DIALOGUES, QA) + (
    "SELECT split, (row_number() OVER (PARTITION BY file_no ORDER BY row_id) - 1)::BIGINT AS row_id, "
    "md5(coalesce(Brand, '') || '|' || coalesce(Model, '') || '|' || coalesce(Question, '') || '|' || coalesce(Dialogue, '') "
    "|| '|' || CASE WHEN file_no = 0 THEN coalesce(Report, '') ELSE '' END) AS cells_md5 FROM qa"
)

ORACLE["dictionary_file"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL) + (
    "SELECT word, freq FROM vocab WHERE NOT regexp_matches(word, '\\s')"
)

ORACLE["saved_embeddings"] = with_(DIALOGUES, QA, SEG, LINES) + "SELECT word, 16::BIGINT AS dims, true AS sound FROM w2v_vocab"

ORACLE["map_partitions"] = "SELECT doc_id, length(text) AS n FROM documents"


def _grams(expr: str) -> str:
    """Distinct 3..6-character n-grams of ``<expr>`` as rows ``(src, g)``."""
    parts = []
    for n in range(3, 7):
        parts.append(
            f"SELECT src, unnest(list_transform(range(1, greatest(length(m) - {n} + 2, 1)), lambda i: substring(m, i, {n}))) AS g "
            f"FROM (SELECT {expr} AS src, '<' || {expr} || '>' AS m FROM {{table}})"
        )
    return " UNION ".join(parts)


SUBWORD = f"""
tgrams AS ({_grams('word').format(table='w2v_vocab')}),
vgrams AS ({_grams('word').format(table='vocab')}),
backed AS (SELECT DISTINCT src AS word FROM vgrams WHERE g IN (SELECT DISTINCT g FROM tgrams))"""

ORACLE["subword_vectors"] = with_(CELLS, TEXT_TOKENS, ALL_TOKENS, VOCAB_ALL, DIALOGUES, QA, SEG, LINES, SUBWORD) + (
    f"SELECT v.word, CASE WHEN w.word IS NOT NULL THEN 'word' WHEN b.word IS NOT NULL THEN 'ngram' END AS source, "
    f"(CASE WHEN w.word IS NOT NULL OR b.word IS NOT NULL THEN {WV_SIZE} ELSE 0 END)::BIGINT AS dims "
    "FROM (SELECT DISTINCT word FROM vocab) v LEFT JOIN w2v_vocab w ON w.word = v.word LEFT JOIN backed b ON b.word = v.word"
)


def alias_sql(name: str, source: str) -> str:
    """Alias tables of ``source(grp, item, w)`` by running sums of whole numbers."""
    order = "(PARTITION BY grp ORDER BY spot, heavy DESC, item ROWS BETWEEN"
    return f"""
{name}_sums AS (
  SELECT grp, item, w, count(*) OVER (PARTITION BY grp) AS m, (sum(w) OVER (PARTITION BY grp))::BIGINT AS total FROM {source}),
{name}_off AS (SELECT *, m * w >= total AS heavy, abs(m * w - total) AS off FROM {name}_sums),
{name}_upto AS (SELECT *, (sum(off) OVER (PARTITION BY grp, heavy ORDER BY item))::BIGINT AS upto FROM {name}_off),
{name}_at AS (SELECT *, CASE WHEN heavy THEN upto ELSE upto - off END AS spot FROM {name}_upto),
{name} AS MATERIALIZED (
  SELECT grp, item, m, total, row_number() OVER (PARTITION BY grp ORDER BY item) - 1 AS slot,
    CASE WHEN heavy THEN total + least(0, upto - coalesce(
      last_value(CASE WHEN NOT heavy THEN upto END IGNORE NULLS) OVER {order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    ELSE m * w END AS cut,
    coalesce(first_value(CASE WHEN heavy THEN item END IGNORE NULLS) OVER {order} 1 FOLLOWING AND UNBOUNDED FOLLOWING), item) AS other
  FROM {name}_at)"""


_DRAW = "CAST('0x' || substr(h, {at}, 15) AS BIGINT)"

ORACLE["negative_samples"] = with_(
    *_SG,
    f"""
wts AS (SELECT idx % {BLOCKS} AS grp, idx AS item, greatest(floor(ln((idx + 2)::DOUBLE / (idx + 1)) * {UNIT}), 1)::BIGINT AS w FROM vocab),
blks AS (SELECT 0 AS grp, grp AS item, sum(w)::BIGINT AS w FROM wts GROUP BY wts.grp)""",
    alias_sql("top", "blks"),
    alias_sql("sub", "wts"),
    f"""
draws AS (
  SELECT batch, k, sha256('1:' || batch || ':' || k) AS h
  FROM (SELECT batch, unnest(range(0, {SG_NEGATIVES})) AS k FROM (SELECT DISTINCT batch FROM bat))),
nums AS MATERIALIZED (
  SELECT batch, k, {_DRAW.format(at=1)} % b.n AS slot, {_DRAW.format(at=17)} AS u1, {_DRAW.format(at=33)} AS u2, {_DRAW.format(at=49)} AS u3
  FROM draws, (SELECT count(*) AS n FROM blks) b),
drawn AS MATERIALIZED (
  SELECT batch, k, u2, u3, CASE WHEN u1 % t.total < t.cut THEN t.item ELSE t.other END AS block FROM nums JOIN top t USING (slot)),
sized AS (SELECT DISTINCT grp AS block, m FROM sub),
placed AS MATERIALIZED (SELECT d.batch, d.k, d.u3, d.block, d.u2 % z.m AS slot FROM drawn d JOIN sized z USING (block))""",
) + (
    "SELECT p.batch, p.k, CASE WHEN p.u3 % s.total < s.cut THEN s.item ELSE s.other END AS idx "
    "FROM placed p JOIN sub s ON s.grp = p.block AND s.slot = p.slot"
)

# The leading singular vector by power iteration; the others have no statement in SQL (tests have a dense decomposition).
ORACLE["ppmi_vectors"] = with_recursive(
    *_SG, context_sql("a.r"), COOC,
    """
pm AS (
  SELECT w, c, v FROM (
    SELECT o.w, o.c, ln(o.n::DOUBLE * (SELECT total FROM ctot) / (cw.n_w::DOUBLE * cc.n_c)) AS v
    FROM cooc o JOIN cw ON cw.w = o.w JOIN cc ON cc.c = o.c) WHERE v > 0),
pow AS (
  SELECT 0 AS t, w, 1.0::DOUBLE AS x FROM (SELECT DISTINCT w FROM pm)
  UNION ALL
  SELECT t + 1, w, z / sqrt(sum(z * z) OVER ()) FROM (
    SELECT y.t, p.w, sum(p.v * y.y) AS z FROM pm p JOIN (
      SELECT pow.t, q.c, sum(q.v * pow.x) AS y FROM pow JOIN pm q ON q.w = pow.w WHERE pow.t < 200 GROUP BY pow.t, q.c
    ) y ON y.c = p.c GROUP BY y.t, p.w))""",
) + f"SELECT w AS idx, {PPMI_SIZE}::BIGINT AS dims, round(x, 5) AS first FROM pow WHERE t = 200"


def _half(name: str, where: str) -> str:
    """PPMI rows of the pairs of some batches."""
    return f"""
{name}_co AS (SELECT center AS w, context AS c, count(*) AS n FROM ctxp WHERE {where} GROUP BY center, context),
{name} AS (
  SELECT o.w, o.c FROM {name}_co o
  JOIN (SELECT w, sum(n) AS n_w FROM {name}_co GROUP BY w) a ON a.w = o.w JOIN (SELECT c, sum(n) AS n_c FROM {name}_co GROUP BY c) b ON b.c = o.c
  WHERE ln(o.n::DOUBLE * (SELECT sum(n) FROM {name}_co) / (a.n_w::DOUBLE * b.n_c)) > 0)"""


ORACLE["fold_in_vectors"] = with_(*_SG, context_sql("a.r"), _half("even", "batch % 2 = 0"), _half("whole", "true")) + (
    f"SELECT DISTINCT w AS idx, 'base' AS source, {PPMI_SIZE}::BIGINT AS dims, true AS sound FROM even "
    f"UNION ALL SELECT DISTINCT w, 'folded', {PPMI_SIZE}::BIGINT, true FROM whole "
    "WHERE w NOT IN (SELECT w FROM even) AND c IN (SELECT c FROM even)"
)

ORACLE["bucketed_matrix"] = ORACLE["embedding_matrix"]

ORACLE["fitted_subwords"] = with_(*_SG, context_sql("a.r"), _half("whole", "true")) + (
    f"SELECT word, CASE WHEN idx IN (SELECT w FROM whole) THEN 'word' ELSE 'ngram' END AS source, {PPMI_SIZE}::BIGINT AS dims "
    "FROM vocab_all WHERE length(word) > 0"
)
