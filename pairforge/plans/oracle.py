"""DuckDB twins of the contract queries (the correctness oracle).

Written in plain long-form SQL (window functions, joins, ``string_agg``) over the
pre-registered tables, independent of the Spark operators they check.
Transcendental results are rounded to 6 places on both sides.
"""

from __future__ import annotations

NL2 = "chr(10) || chr(10)"
# What Python's str.strip() removes, written here on its own (not taken from the code under test).
WS_CODES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201,
            8202, 8232, 8233, 8239, 8287, 12288)
WS = " || ".join(f"chr({c})" for c in WS_CODES)
BOS = "'<|begin_of_text|>'"
HDR = "'<|start_header_id|>'"
HDR_END = f"'<|end_header_id|>' || {NL2}"
EOT = "'<|eot_id|>'"
GEN = f"'<|start_header_id|>assistant<|end_header_id|>' || {NL2}"


def piece(role: str, content: str, first: str) -> str:
    """SQL for one rendered message."""
    return (f"(CASE WHEN {first} THEN {BOS} ELSE '' END || {HDR} || {role} || {HDR_END} || "
            f"trim({content}, {WS}) || {EOT})")


PROMPT_MSGS = """
prompt_msgs AS (
  SELECT c.conv_id AS row_id, c.turn, c.role, c.text AS content
  FROM conversations c
  JOIN (SELECT conv_id, max(turn) FILTER (WHERE role = 'user') AS last_user
        FROM conversations GROUP BY conv_id) u ON c.conv_id = u.conv_id
  WHERE c.turn <= u.last_user
)"""

PROMPT_TEXT = f"""
prompt_text AS (
  SELECT row_id, string_agg(p, '' ORDER BY turn) || {GEN} AS prompt
  FROM (SELECT row_id, turn,
               {piece('role', 'content', 'turn = min(turn) OVER (PARTITION BY row_id)')} AS p
        FROM prompt_msgs) x
  GROUP BY row_id
)"""

SCORED_LONG = """
cand AS (
  SELECT r.row_id, CAST(k.k AS BIGINT) AS k,
         (r.row_id * 37 + k.k * 101 + k.k * k.k * 13) % (SELECT count(*) FROM documents) AS doc_id
  FROM (SELECT DISTINCT conv_id AS row_id FROM conversations WHERE role = 'user') r
  JOIN (SELECT unnest(range(4)) AS k) k ON NOT (r.row_id % 7 = 0 AND k.k = 3)
),
scored_long AS (
  SELECT c.row_id, c.k, d.text AS response,
         CASE WHEN c.row_id % 11 = 0 THEN CAST(1.0 AS DOUBLE)
              ELSE CAST(CAST('0x' || substr(md5(d.text), 1, 4) AS BIGINT) % 41 AS DOUBLE) / 8 - 2.5 END AS reward
  FROM cand c JOIN documents d ON d.doc_id = c.doc_id
),
full_long AS (
  SELECT * FROM scored_long
  WHERE row_id IN (SELECT row_id FROM scored_long GROUP BY row_id HAVING count(*) >= 4)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# --- pair selection ---------------------------------------------------------------

def _pick(strategy: str, lam: str = "CAST(1 AS DOUBLE) / 256") -> str:
    if strategy == "random":
        return "pick AS (SELECT DISTINCT row_id, CAST(0 AS BIGINT) AS i0, CAST(1 AS BIGINT) AS i1 FROM full_long)"
    if strategy == "max_random":
        return """pick AS (
  SELECT row_id, k AS i0, CASE WHEN k = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS i1
  FROM (SELECT row_id, k, row_number() OVER (PARTITION BY row_id ORDER BY reward DESC, k) AS rn FROM full_long) t
  WHERE rn = 1)"""
    if strategy == "max_min":
        return """pick AS (
  SELECT row_id, max(CASE WHEN rmax = 1 THEN k END) AS i0, max(CASE WHEN rmin = 1 THEN k END) AS i1
  FROM (SELECT row_id, k,
               row_number() OVER (PARTITION BY row_id ORDER BY reward DESC, k) AS rmax,
               row_number() OVER (PARTITION BY row_id ORDER BY reward ASC, k) AS rmin
        FROM full_long) t
  GROUP BY row_id)"""
    if strategy == "max_max":
        return """pick AS (
  SELECT row_id, max(CASE WHEN rs = 1 THEN k END) AS i0, max(CASE WHEN rs = 2 THEN k END) AS i1
  FROM (SELECT row_id, k, row_number() OVER (PARTITION BY row_id ORDER BY reward DESC, k DESC) AS rs
        FROM full_long) t
  GROUP BY row_id)"""
    if strategy == "max_min_p":
        return f"""pick AS (
  SELECT row_id, max(CASE WHEN rmax = 1 THEN k END) AS i0, max(CASE WHEN rmin = 1 THEN k END) AS i1
  FROM (SELECT row_id, k,
               row_number() OVER (PARTITION BY row_id ORDER BY reward - length(response) * {lam} DESC, k) AS rmax,
               row_number() OVER (PARTITION BY row_id ORDER BY reward - length(response) * {lam} ASC, k) AS rmin
        FROM full_long) t
  GROUP BY row_id)"""
    raise ValueError(strategy)


def pairs_sql(strategy: str, eot: str = EOT, scale: str = "CAST(1 AS DOUBLE)", tail: str = "") -> str:
    return with_ctes(PROMPT_MSGS, PROMPT_TEXT, SCORED_LONG, _pick(strategy)) + f"""
SELECT p.row_id, pt.prompt,
       CASE WHEN a.reward > b.reward THEN a.response ELSE b.response END || {eot} AS chosen,
       CASE WHEN a.reward > b.reward THEN b.response ELSE a.response END || {eot} AS rejected,
       (CASE WHEN a.reward > b.reward THEN a.reward - b.reward ELSE b.reward - a.reward END) * {scale} AS margin
FROM pick p
JOIN full_long a ON a.row_id = p.row_id AND a.k = p.i0
JOIN full_long b ON b.row_id = p.row_id AND b.k = p.i1
JOIN prompt_text pt ON pt.row_id = p.row_id
WHERE a.reward <> b.reward
{tail}"""


SQL: dict[str, str] = {}

for _s in ("random", "max_random", "max_min", "max_max", "max_min_p"):
    SQL[f"pairs_{_s}"] = pairs_sql(_s)


# --- shared pieces for the remaining queries -----------------------------------------

PROMPT_PLAIN = f"""
prompt_plain AS (
  SELECT row_id, string_agg(p, '' ORDER BY turn) AS ptxt
  FROM (SELECT row_id, turn,
               {piece('role', 'content', 'turn = min(turn) OVER (PARTITION BY row_id)')} AS p
        FROM prompt_msgs) x
  GROUP BY row_id
)"""


def rm_text(prompt_plain: str, response: str) -> str:
    return f"replace({prompt_plain} || {piece(chr(39) + 'assistant' + chr(39), response, 'false')}, {BOS}, '')"


def toks(text: str) -> str:
    return (f"list_transform(list_filter(string_split_regex({text}, '[ \\t\\n\\r]+'), lambda q: q <> ''), "
            f"lambda q: CAST('0x' || substr(md5(q), 1, 6) AS BIGINT))")


def md5_reward(text: str) -> str:
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 4) AS BIGINT) % 41 AS DOUBLE) / 8 - 2.5)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def LS(x: str) -> str:
    return f"(least({x}, 0) - ln(1 + exp(-abs({x}))))"


def SP(x: str) -> str:
    return f"(greatest({x}, 0) + ln(1 + exp(-abs({x}))))"


def SIG(x: str) -> str:
    return f"(CASE WHEN ({x}) >= 0 THEN 1 / (1 + exp(-({x}))) ELSE exp({x}) / (1 + exp({x})) END)"


B = "CAST(0.125 AS DOUBLE)"
EXACT_LOSSES = ("hinge", "ipo", "sppo_hard")

LOGPS = """
lp AS (
  SELECT event_id AS pair_id, event_id // 16 AS batch_id,
         CAST(-(((event_id % 4001) * 7919) % 4001) AS DOUBLE) / 64 AS pc,
         CAST(-(((event_id % 4003) * 104729) % 4003) AS DOUBLE) / 64 AS pr,
         CAST(-(((event_id % 3989) * 1299709) % 3989) AS DOUBLE) / 64 AS rc,
         CAST(-(((event_id % 3967) * 15485863) % 3967) AS DOUBLE) / 64 AS rr
  FROM events
)"""

TOKENS = """
tok AS (
  SELECT vec_id // 10 AS seq_id, vec_id % 10 AS pos,
         CASE WHEN vec_id % 10 < 3 THEN -100 ELSE label END AS label,
         CAST(embedding AS DOUBLE[]) AS logits
  FROM embeddings
),
sh AS (
  SELECT a.seq_id, a.pos, b.label AS target, a.logits
  FROM tok a JOIN tok b ON b.seq_id = a.seq_id AND b.pos = a.pos + 1
),
tl AS (
  SELECT seq_id, pos, target,
         CASE WHEN target = -100 THEN CAST(0 AS DOUBLE)
              ELSE logits[target + 1] - (list_max(logits)
                   + ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))))) END AS lp
  FROM sh
),
seqs AS (
  SELECT seq_id, sum(lp) AS logps, count(*) FILTER (WHERE target <> -100) AS n_tokens FROM tl GROUP BY seq_id
),
tpairs AS (
  SELECT seq_id // 2 AS pair_id, (seq_id // 2) // 4 AS batch_id,
         sum(CASE WHEN seq_id % 2 = 0 THEN logps END) AS pc,
         sum(CASE WHEN seq_id % 2 = 1 THEN logps END) AS pr,
         sum(CASE WHEN seq_id % 2 = 0 THEN n_tokens END) AS chosen_tokens,
         sum(CASE WHEN seq_id % 2 = 1 THEN n_tokens END) AS rejected_tokens
  FROM seqs GROUP BY seq_id // 2
),
nll AS (
  SELECT (seq_id // 2) // 4 AS batch_id, -sum(lp) / count(*) FILTER (WHERE target <> -100) AS nll_loss
  FROM tl WHERE seq_id % 2 = 0 GROUP BY 1
),
polref AS (
  SELECT t.pair_id, t.batch_id, t.pc, t.pr, l.rc, l.rr FROM tpairs t JOIN lp l ON l.pair_id = t.pair_id
)"""


def loss_expr(loss_type: str, eps: float = 0.0, div: str = "reverse_kl", alpha: float = 1.0,
              ref_free: bool = False) -> str:
    w = "pc" if ref_free else "(pc - rc)"
    l = "pr" if ref_free else "(pr - rr)"
    if div == "alpha_divergence":
        a = f"CAST({alpha} AS DOUBLE)"
        z = f"((exp(least({l} * -{a}, 709.7827)) - exp(least({w} * -{a}, 709.7827))) / {a})"
    else:
        z = "(pc - pr)" if ref_free else "((pc - pr) - (rc - rr))"
        if div == "js_divergence":
            z = f"({z} - ({SP(w)} - {SP(l)}))"
    bz = f"({B} * {z})"
    nbz = f"(-{bz})"
    e = f"CAST({eps} AS DOUBLE)"
    if loss_type == "sigmoid":
        return f"(-{LS(bz)} * (1 - {e}) - {LS(nbz)} * {e})"
    if loss_type == "robust":
        return f"((-{LS(bz)} * (1 - {e}) + {LS(nbz)} * {e}) / (1 - 2 * {e}))"
    if loss_type == "exo_pair":
        ee = eps if eps else 1e-3
        return f"({SIG(bz)} * ({LS(bz)} - ln(1 - {ee})) + {SIG(nbz)} * ({LS(nbz)} - ln({ee})))"
    if loss_type == "hinge":
        return f"greatest(0, 1 - {bz})"
    if loss_type == "ipo":
        return f"(({z} - 1 / (2 * {B})) * ({z} - 1 / (2 * {B})))"
    if loss_type == "sppo_hard":
        return f"(((pc - rc) - 0.5 / {B}) * ((pc - rc) - 0.5 / {B}) + ((pr - rr) + 0.5 / {B}) * ((pr - rr) + 0.5 / {B}))"
    if loss_type == "nca_pair":
        c, r = f"((pc - rc) * {B})", f"((pr - rr) * {B})"
        return f"(-{LS(c)} - 0.5 * {LS('-' + c)} - 0.5 * {LS('-' + r)})"
    if loss_type == "apo_zero":
        return f"((1 - {SIG(B + ' * ' + w)}) + {SIG(B + ' * ' + l)})"
    if loss_type == "apo_down":
        return f"({SIG(B + ' * ' + w)} + (1 - {SIG(B + ' * (' + w + ' - ' + l + ')')}))"
    raise ValueError(loss_type)


def loss_sql(loss_type: str, **kw) -> str:
    rewards = f"{B} * (pc - rc) AS chosen_reward, {B} * (pr - rr) AS rejected_reward"
    if loss_type == "bco_pair":
        return with_ctes(LOGPS, f"""
bx AS (SELECT batch_id, (sum({B} * (pc - rc)) + sum({B} * (pr - rr))) / (2 * count(*)) AS x FROM lp GROUP BY batch_id),
bd AS (SELECT batch_id, avg(x) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d FROM bx)""") + f"""
SELECT lp.pair_id, lp.batch_id,
       {r6(f"-{LS(f'{B} * (pc - rc) - d')} - {LS(f'-({B} * (pr - rr) - d)')}")} AS loss, {rewards}
FROM lp JOIN bd ON bd.batch_id = lp.batch_id"""
    if loss_type in ("aot", "aot_pair"):
        a, c = ("pc - rc", "pr - rr") if loss_type == "aot_pair" else ("pc - pr", "rc - rr")
        return with_ctes(LOGPS, f"""
ra AS (SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY {a}) - 1 AS rank, {a} AS v FROM lp),
rc_ AS (SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY {c}) - 1 AS rank, {c} AS v FROM lp)""") + f"""
SELECT ra.batch_id, ra.rank, {r6(f"-{LS(f'{B} * (ra.v - rc_.v)')}")} AS loss
FROM ra JOIN rc_ ON rc_.batch_id = ra.batch_id AND rc_.rank = ra.rank"""
    loss = loss_expr(loss_type, **kw)
    loss = loss if loss_type in EXACT_LOSSES else r6(loss)
    return with_ctes(LOGPS) + f"SELECT pair_id, batch_id, {loss} AS loss, {rewards} FROM lp"


for _t in ("sigmoid", "robust", "exo_pair", "hinge", "ipo", "bco_pair", "sppo_hard", "nca_pair",
           "aot_pair", "aot", "apo_zero", "apo_down"):
    SQL[f"loss_{_t}"] = loss_sql(_t, eps=0.125 if _t == "robust" else 0.0)
SQL["loss_sigmoid_alpha"] = loss_sql("sigmoid", div="alpha_divergence", alpha=0.125)
SQL["loss_sigmoid_js"] = loss_sql("sigmoid", div="js_divergence")
SQL["loss_sigmoid_smoothed"] = loss_sql("sigmoid", eps=0.1)
SQL["loss_sigmoid_ref_free"] = loss_sql("sigmoid", ref_free=True)

SQL["implicit_rewards"] = with_ctes(LOGPS) + \
    f"SELECT pair_id, {B} * (pc - rc) AS chosen_reward, {B} * (pr - rr) AS rejected_reward FROM lp"

SQL["batch_loss"] = with_ctes(LOGPS) + \
    f"SELECT batch_id, {r6('avg(' + loss_expr('sigmoid') + ')')} AS loss FROM lp GROUP BY batch_id"

SQL["batch_loss_aux"] = with_ctes(LOGPS) + \
    f"SELECT batch_id, {r6('avg(' + loss_expr('sigmoid') + ') + 0.5 * (batch_id % 7) / 8.0')} AS loss FROM lp GROUP BY batch_id"

SQL["ref_logps_join"] = with_ctes(LOGPS, TOKENS) + """
SELECT pair_id, round(pc, 6) AS policy_chosen_logps, round(pr, 6) AS policy_rejected_logps,
       round(rc, 6) AS reference_chosen_logps, round(rr, 6) AS reference_rejected_logps FROM polref"""

SQL["loss_rpo"] = with_ctes(LOGPS, TOKENS) + f"""
SELECT p.pair_id, p.batch_id, {r6(loss_expr('sigmoid') + ' + 0.5 * n.nll_loss')} AS loss
FROM polref p JOIN nll n ON n.batch_id = p.batch_id"""

_METRICS = [
    ("rewards/chosen", f"avg({B} * (pc - rc))"),
    ("rewards/rejected", f"avg({B} * (pr - rr))"),
    ("rewards/accuracies", f"avg(CASE WHEN {B} * (pc - rc) > {B} * (pr - rr) THEN 1.0 ELSE 0.0 END)"),
    ("rewards/margins", f"avg({B} * (pc - rc) - {B} * (pr - rr))"),
    ("logps/rejected", "avg(pr)"),
    ("logps/chosen", "avg(pc)"),
    ("logits/rejected", "max(lg.lr)"),
    ("logits/chosen", "max(lg.lc)"),
    ("nll_loss", "max(n.nll_loss)"),
]


def _metrics_sql() -> str:
    parts = []
    for split, src in (("train", "(SELECT * FROM polref WHERE pair_id % 5 <> 1)"), ("eval", "(SELECT * FROM polref WHERE pair_id % 5 = 1)")):
        prefix = "eval_" if split == "eval" else ""
        for name, expr in _METRICS:
            parts.append(
                f"SELECT '{split}' AS split, p.batch_id, '{prefix}{name}' AS metric, round(CAST({expr} AS DOUBLE), 6) AS value "
                f"FROM {src} p JOIN lg ON lg.batch_id = p.batch_id JOIN nll n ON n.batch_id = p.batch_id GROUP BY p.batch_id")
    return "\nUNION ALL\n".join(parts)


SQL["batch_metrics"] = with_ctes(LOGPS, TOKENS, """
lg AS (
  SELECT (seq_id // 2) // 4 AS batch_id,
         sum(CASE WHEN seq_id % 2 = 0 THEN list_sum(logits) END) / sum(CASE WHEN seq_id % 2 = 0 THEN len(logits) END) AS lc,
         sum(CASE WHEN seq_id % 2 = 1 THEN list_sum(logits) END) / sum(CASE WHEN seq_id % 2 = 1 THEN len(logits) END) AS lr
  FROM tok GROUP BY 1
)""") + _metrics_sql()

SQL["seq_logps"] = with_ctes(TOKENS) + "SELECT seq_id, round(logps, 6) AS logps, n_tokens FROM seqs"
SQL["seq_logps_chunked"] = SQL["seq_logps"]
SQL["seq_logps_avg"] = with_ctes(TOKENS) + "SELECT seq_id, round(logps / nullif(n_tokens, 0), 6) AS logps FROM seqs"
SQL["batch_nll"] = with_ctes(TOKENS) + "SELECT batch_id, round(nll_loss, 6) AS nll_loss FROM nll"
SQL["stack_split"] = with_ctes(TOKENS) + """
SELECT pair_id, round(pc, 6) AS chosen_logps, round(pr, 6) AS rejected_logps,
       CAST(chosen_tokens AS BIGINT) AS chosen_tokens, CAST(rejected_tokens AS BIGINT) AS rejected_tokens FROM tpairs"""
SQL["align_labels"] = with_ctes(TOKENS) + """
SELECT seq_id, round(sum(lp), 6) AS logps, count(*) FILTER (WHERE target <> -100) AS n_tokens
FROM tl WHERE pos >= 2 GROUP BY seq_id"""

SQL["pack_blocks"] = f"""
WITH d AS (SELECT doc_id, CAST(len({toks('text')}) AS BIGINT) AS n FROM documents),
o AS (SELECT doc_id, n, CAST(coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
      FROM d),
b AS (SELECT doc_id, s, s + n AS e, unnest(range(s // 4096, (s + n - 1) // 4096 + 1)) AS block_id FROM o WHERE n > 0)
SELECT block_id, doc_id, greatest(s, block_id * 4096) - block_id * 4096 AS start_in_block,
       greatest(s, block_id * 4096) - s AS offset_in_seq,
       least(e, (block_id + 1) * 4096) - greatest(s, block_id * 4096) AS n_tokens
FROM b"""

_PACK = """
o AS (SELECT k, n, CAST(coalesce(sum(n) OVER (ORDER BY k, n, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM d),
b AS (SELECT k, s, s + n AS e, unnest(range(s // 4096, (s + n - 1) // 4096 + 1)) AS block_id FROM o WHERE n > 0)
SELECT block_id, k AS hash_key, greatest(s, block_id * 4096) - block_id * 4096 AS start_in_block,
       greatest(s, block_id * 4096) - s AS offset_in_seq,
       least(e, (block_id + 1) * 4096) - greatest(s, block_id * 4096) AS n_tokens
FROM b"""
SQL["pack_hash_keys"] = f"""
WITH d AS (
  SELECT doc_id AS i, 8 * CASE WHEN doc_id % 97 % 2 = 0 THEN 1 ELSE -1 END
         * CAST('0x' || substr(md5(CAST(doc_id % 97 AS VARCHAR)), 1, 15) AS BIGINT) AS k, CAST(len({toks('text')}) AS BIGINT) AS n
  FROM documents),""" + _PACK


def trigrams(text: str) -> str:
    """SQL for the ids of the pieces of three characters."""
    return (f"list_transform(range(0, CAST(ceil(length({text}) / 3.0) AS BIGINT)), "
            f"lambda i: CAST('0x' || substr(md5(substr({text}, 3 * i + 1, 3)), 1, 6) AS BIGINT))")


SQL["pack_tokens_hook"] = f"""
WITH d AS (SELECT doc_id, unnest({trigrams('text')}) AS id, unnest(range(0, CAST(ceil(length(text) / 3.0) AS BIGINT))) AS piece FROM documents),
p AS (SELECT id, row_number() OVER (ORDER BY doc_id, piece) - 1 AS pos FROM d)
SELECT pos // 4096 AS block_id, count(*) AS n_tokens, arg_min(id, pos) AS first_id, arg_max(id, pos) AS last_id,
       CAST(sum(id) AS BIGINT) AS id_sum FROM p GROUP BY 1"""

# --- rendering -----------------------------------------------------------------------

SQL["render_sft"] = f"""
SELECT conv_id AS row_id, string_agg(p, '' ORDER BY turn) AS text
FROM (SELECT conv_id, turn, {piece('role', 'text', 'turn = min(turn) OVER (PARTITION BY conv_id)')} AS p
      FROM conversations) x
GROUP BY conv_id"""

SQL["render_prompt"] = with_ctes(PROMPT_MSGS, PROMPT_TEXT) + "SELECT row_id, prompt FROM prompt_text"

SQL["render_rm_text"] = with_ctes(PROMPT_MSGS, PROMPT_PLAIN, SCORED_LONG) + f"""
SELECT f.row_id, f.k, {rm_text('pp.ptxt', 'f.response')} AS rm_text
FROM full_long f JOIN prompt_plain pp ON pp.row_id = f.row_id"""

SQL["strip_echo"] = with_ctes(PROMPT_MSGS, PROMPT_TEXT, SCORED_LONG) + """
SELECT f.row_id, f.k, substr(pt.prompt || f.response, length(pt.prompt) + 1) AS response
FROM full_long f JOIN prompt_text pt ON pt.row_id = f.row_id"""

SQL["normalise_chat"] = """
SELECT conv_id AS row_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS turn,
       role, text AS content
FROM conversations"""

SQL["role_mask"] = f"""
SELECT row_id, turn, CAST(len(ids) AS BIGINT) AS n_tokens,
       CAST(CASE WHEN role = 'assistant' THEN len(ids) ELSE 0 END AS BIGINT) AS n_trained,
       CAST(CASE WHEN role = 'assistant' THEN coalesce(list_sum(ids), 0) ELSE 0 END AS BIGINT) AS trained_id_sum
FROM (SELECT conv_id AS row_id, turn, role, {toks('text')} AS ids FROM conversations) x
WHERE len(ids) > 0"""

SQL["role_mask_hook"] = f"""
SELECT row_id, turn, CAST(len(ids) AS BIGINT) AS n_tokens,
       CAST(CASE WHEN role = 'assistant' THEN len(ids) ELSE 0 END AS BIGINT) AS n_trained,
       CAST(CASE WHEN role = 'assistant' THEN coalesce(list_sum(ids), 0) ELSE 0 END AS BIGINT) AS trained_id_sum
FROM (SELECT conv_id AS row_id, turn, role, {trigrams('text')} AS ids FROM conversations) x
WHERE len(ids) > 0"""

# --- candidates ------------------------------------------------------------------------

SQL["candidates_join"] = with_ctes(PROMPT_MSGS, SCORED_LONG) + """
SELECT m.row_id, m.n_messages, r.n_responses, r.response_chars
FROM (SELECT row_id, count(*) AS n_messages FROM prompt_msgs GROUP BY row_id) m
JOIN (SELECT row_id, count(*) AS n_responses, CAST(sum(length(response)) AS BIGINT) AS response_chars
      FROM scored_long GROUP BY row_id) r ON r.row_id = m.row_id"""

SQL["candidates_wide"] = with_ctes(SCORED_LONG) + "SELECT row_id, k, response, reward FROM scored_long"
SQL["candidates_long"] = SQL["candidates_wide"]
SQL["jsonl_round_trip"] = SQL["candidates_wide"]
SQL["first_score"] = with_ctes(SCORED_LONG) + "SELECT row_id, k, reward AS score FROM scored_long"

SQL["overlength_guard"] = with_ctes(PROMPT_MSGS, PROMPT_TEXT, SCORED_LONG) + """
SELECT pt.row_id, CAST(CASE WHEN length(pt.prompt) > 3000 THEN 0 ELSE c.n END AS BIGINT) AS n_responses
FROM prompt_text pt JOIN (SELECT row_id, count(*) AS n FROM scored_long GROUP BY row_id) c ON c.row_id = pt.row_id"""

SQL["drop_short"] = with_ctes(SCORED_LONG) + \
    "SELECT row_id, count(*) AS n_responses FROM scored_long GROUP BY row_id HAVING count(*) >= 4"

# --- pairs: outcomes, multi, eval, head ---------------------------------------------------


def _outcomes_sql() -> str:
    parts = []
    for s in ("random", "max_random", "max_min", "max_max", "max_min_p"):
        pick = _pick(s).replace("full_long", "scored_long").replace("pick AS", f"pick_{s} AS", 1)
        parts.append((pick, f"""
SELECT '{s}' AS strategy, CASE WHEN a.reward = b.reward THEN 'tied' ELSE 'kept' END AS outcome
FROM pick_{s} p JOIN scored_long a ON a.row_id = p.row_id AND a.k = p.i0
JOIN scored_long b ON b.row_id = p.row_id AND b.k = p.i1"""))
    return with_ctes(SCORED_LONG, *[p for p, _ in parts]) + \
        "SELECT strategy, outcome, count(*) AS n FROM (" + " UNION ALL ".join(q for _, q in parts) + \
        ") o GROUP BY strategy, outcome"


SQL["pair_outcomes"] = _outcomes_sql()

SQL["pairs_multi"] = with_ctes(PROMPT_MSGS, PROMPT_TEXT, SCORED_LONG, """
best AS (SELECT row_id, k AS i0 FROM (
  SELECT row_id, k, row_number() OVER (PARTITION BY row_id ORDER BY reward DESC, k) AS rn FROM full_long) t WHERE rn = 1)""") + f"""
SELECT f.row_id, CAST(CASE WHEN f.k < b.i0 THEN f.k ELSE f.k - 1 END AS BIGINT) AS pair_idx, pt.prompt,
       a.response || {EOT} AS chosen, f.response || {EOT} AS rejected,
       (a.reward - f.reward) * CAST(1 AS DOUBLE) AS margin
FROM full_long f JOIN best b ON b.row_id = f.row_id
JOIN full_long a ON a.row_id = b.row_id AND a.k = b.i0
JOIN prompt_text pt ON pt.row_id = f.row_id
WHERE f.k <> b.i0"""

SQL["pairs_eval"] = pairs_sql("random", tail="ORDER BY p.row_id LIMIT 100")
SQL["pairs_head"] = pairs_sql("max_min", tail="ORDER BY p.row_id LIMIT 50")

# --- summaries --------------------------------------------------------------------------

SQL["score_summary"] = with_ctes(SCORED_LONG) + """
SELECT count(*) AS n_input, count(*) FILTER (WHERE n >= 4) AS n_collected,
       count(*) FILTER (WHERE n >= 4) < count(*) AS short,
       sum(s) FILTER (WHERE n >= 4) / sum(n) FILTER (WHERE n >= 4) AS mean_score,
       avg(mx) FILTER (WHERE n >= 4) AS top1_score
FROM (SELECT row_id, count(*) AS n, sum(reward) AS s, max(reward) AS mx FROM scored_long GROUP BY row_id) t"""

SQL["run_record"] = with_ctes(SCORED_LONG, """
fr AS (SELECT row_id, count(*) AS n, sum(reward) AS s, max(reward) AS mx FROM full_long GROUP BY row_id),
ord AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS o, count(*) OVER () AS total FROM fr)""") + """
SELECT CAST(o // (total // 3 + 1) + 1 AS BIGINT) AS iteration, count(*) AS n,
       sum(s) / sum(n) AS mean_score, avg(mx) AS top1_score
FROM ord GROUP BY 1"""

SQL["shard_counts"] = with_ctes(SCORED_LONG) + """
SELECT shard, count(*) AS n FROM (
  SELECT CAST((row_number() OVER (ORDER BY row_id) - 1) % 8 AS BIGINT) AS shard
  FROM (SELECT DISTINCT row_id FROM full_long) r) t
GROUP BY shard"""

# --- ordering ---------------------------------------------------------------------------

_ORD = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal, count(*) OVER () AS n FROM orders"
SQL["shard_floor"] = f"""
SELECT o_orderkey, ordinal, CAST(ordinal // (n // 7) AS BIGINT) AS shard FROM ({_ORD}) t
WHERE ordinal // (n // 7) < 7"""
SQL["shard_cover"] = f"SELECT o_orderkey, ordinal, CAST(ordinal // (n // 7 + 1) AS BIGINT) AS shard FROM ({_ORD}) t"
SQL["shard_round_robin"] = f"SELECT o_orderkey, CAST(ordinal % 7 AS BIGINT) AS shard FROM ({_ORD}) t"
SQL["ordinal"] = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal FROM orders"
SQL["shuffle_merge"] = """
SELECT doc_id, CAST(o // (n // 8 + 1) AS BIGINT) AS shard, row_number() OVER (ORDER BY h, doc_id) - 1 AS position
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, count(*) OVER () AS n,
             CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h
      FROM documents) t"""

# --- truncation, hooks, iteration --------------------------------------------------------

SQL["truncate_end"] = f"""
WITH pr AS ({pairs_sql('max_min')}),
t AS (SELECT row_id, {toks('prompt')} AS p, {toks('chosen')} AS c, {toks('rejected')} AS r FROM pr),
n AS (SELECT *, len(p) AS np, len(c) AS nc, len(r) AS nr, greatest(len(c), len(r)) AS lg FROM t),
n2 AS (SELECT *, CASE WHEN np + lg > 2048 THEN least(np, 1000) ELSE np END AS np2 FROM n),
n3 AS (SELECT *, CASE WHEN np2 + lg > 2048 THEN least(nc, 1048) ELSE nc END AS nc2,
                 CASE WHEN np2 + lg > 2048 THEN least(nr, 1048) ELSE nr END AS nr2 FROM n2)
SELECT row_id, CAST(np2 AS BIGINT) AS prompt_len, CAST(nc2 AS BIGINT) AS chosen_len, CAST(nr2 AS BIGINT) AS rejected_len,
       CASE WHEN np2 > 0 THEN p[np - np2 + 1] END AS prompt_first,
       CASE WHEN nc2 > 0 THEN c[nc2] END AS chosen_last,
       CASE WHEN nr2 > 0 THEN r[nr2] END AS rejected_last
FROM n3"""

SQL["truncate_hook"] = f"""
WITH pr AS ({pairs_sql('max_min')}),
t AS (SELECT row_id, {trigrams('prompt')} AS p, {trigrams('chosen')} AS c, {trigrams('rejected')} AS r FROM pr),
n AS (SELECT *, len(p) AS np, len(c) AS nc, len(r) AS nr, greatest(len(c), len(r)) AS lg FROM t),
n2 AS (SELECT *, CASE WHEN np + lg > 2048 THEN least(np, 1000) ELSE np END AS np2 FROM n),
n3 AS (SELECT *, CASE WHEN np2 + lg > 2048 THEN least(nc, 1048) ELSE nc END AS nc2,
                 CASE WHEN np2 + lg > 2048 THEN least(nr, 1048) ELSE nr END AS nr2 FROM n2)
SELECT row_id, CAST(np2 AS BIGINT) AS prompt_len, CAST(nc2 AS BIGINT) AS chosen_len, CAST(nr2 AS BIGINT) AS rejected_len,
       CASE WHEN np2 > 0 THEN p[np2] END AS prompt_last,
       CASE WHEN nc2 > 0 THEN c[nc2] END AS chosen_last,
       CASE WHEN nr2 > 0 THEN r[nr2] END AS rejected_last
FROM n3"""

SQL["generate_hook"] = with_ctes(PROMPT_MSGS, PROMPT_TEXT) + """
SELECT pt.row_id, CAST(k.k AS BIGINT) AS k, 'response ' || k.k || ' of ' || length(pt.prompt) AS response
FROM prompt_text pt CROSS JOIN (SELECT unnest(range(4)) AS k) k"""

SQL["score_hook"] = with_ctes(PROMPT_MSGS, PROMPT_PLAIN, SCORED_LONG) + f"""
SELECT f.row_id, f.k, {md5_reward(rm_text('pp.ptxt', 'f.response'))} AS reward
FROM full_long f JOIN prompt_plain pp ON pp.row_id = f.row_id"""

_GEN_SCORED = (PROMPT_MSGS, PROMPT_TEXT, PROMPT_PLAIN, """
sets AS (SELECT row_id, prompt, row_number() OVER (ORDER BY row_id) - 1 AS o, count(*) OVER () AS n FROM prompt_text),
gen AS (SELECT s.row_id, CAST(s.o // (s.n // 3 + 1) + 1 AS BIGINT) AS iteration, k.k,
               'iter' || CAST(s.o // (s.n // 3 + 1) + 1 AS VARCHAR) || ' response ' || k.k || ' of ' || length(s.prompt) AS response
        FROM sets s CROSS JOIN (SELECT unnest(range(4)) AS k) k)""", f"""
sc AS (SELECT g.*, {md5_reward(rm_text('pp.ptxt', 'g.response'))} AS reward
       FROM gen g JOIN prompt_plain pp ON pp.row_id = g.row_id)""")

SQL["iterate3_records"] = with_ctes(*_GEN_SCORED) + """
SELECT iteration, avg(reward) AS mean_score, avg(mx) AS top1_score
FROM (SELECT *, CASE WHEN k = 0 THEN max(reward) OVER (PARTITION BY row_id) END AS mx FROM sc) t GROUP BY iteration"""

SQL["iterate3"] = with_ctes(*_GEN_SCORED, """
pick AS (
  SELECT row_id, max(CASE WHEN rmax = 1 THEN k END) AS i0, max(CASE WHEN rmin = 1 THEN k END) AS i1
  FROM (SELECT row_id, k,
               row_number() OVER (PARTITION BY row_id ORDER BY reward DESC, k) AS rmax,
               row_number() OVER (PARTITION BY row_id ORDER BY reward ASC, k) AS rmin
        FROM sc) t
  GROUP BY row_id)""") + f"""
SELECT a.iteration, p.row_id,
       CASE WHEN a.reward > b.reward THEN a.response ELSE b.response END || {EOT} AS chosen,
       CASE WHEN a.reward > b.reward THEN b.response ELSE a.response END || {EOT} AS rejected,
       CASE WHEN a.reward > b.reward THEN a.reward - b.reward ELSE b.reward - a.reward END AS margin
FROM pick p JOIN sc a ON a.row_id = p.row_id AND a.k = p.i0 JOIN sc b ON b.row_id = p.row_id AND b.k = p.i1
WHERE a.reward <> b.reward"""

SQL["generate_hook_wide"] = SQL["generate_hook"]
SQL["score_hook_wide"] = SQL["score_hook"]
SQL["stream_pairs"] = SQL["pairs_max_min"]
SQL["pairs_max_min_scaled"] = pairs_sql("max_min", scale="CAST(0.5 AS DOUBLE)")
SQL["shard_union"] = """
SELECT CAST(o // (n // 8 + 1) AS BIGINT) AS shard, count(*) AS n, count(DISTINCT doc_id) AS n_docs
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, count(*) OVER () AS n FROM documents) t
GROUP BY 1"""
SQL["score_hook_batch"] = SQL["score_hook"]

SQL["sft_pack"] = f"""
WITH r AS (
  SELECT conv_id AS row_id, string_agg(p, '' ORDER BY turn) AS text
  FROM (SELECT conv_id, turn, {piece('role', 'text', 'turn = min(turn) OVER (PARTITION BY conv_id)')} AS p
        FROM conversations) x
  GROUP BY conv_id
),
d AS (SELECT row_id, CAST(len({toks('text')}) AS BIGINT) AS n FROM r),
o AS (SELECT row_id, n, CAST(coalesce(sum(n) OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
      FROM d),
b AS (SELECT row_id, s, s + n AS e, unnest(range(s // 4096, (s + n - 1) // 4096 + 1)) AS block_id FROM o WHERE n > 0)
SELECT block_id, row_id, greatest(s, block_id * 4096) - block_id * 4096 AS start_in_block,
       greatest(s, block_id * 4096) - s AS offset_in_seq,
       least(e, (block_id + 1) * 4096) - greatest(s, block_id * 4096) AS n_tokens
FROM b"""
SQL["stream_loss_sigmoid"] = SQL["loss_sigmoid"]
SQL["pairs_from_jsonl"] = "SELECT prompt, chosen, rejected, margin FROM (" + pairs_sql("max_min") + ") t"
SQL["render_sft_long"] = SQL["render_sft"]


# --- cases that the plain inputs lack ----------------------------------------------------

SQL["ordinal_hash_keys"] = """
SELECT o_orderkey, hash_key, row_number() OVER (ORDER BY hash_key, o_orderkey) - 1 AS ordinal
FROM (SELECT o_orderkey, 8 * CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE -1 END
             * CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 15) AS BIGINT) AS hash_key FROM orders) t"""

SQL["shard_files"] = """
SELECT doc_id, lang, n_chars,
       CAST((row_number() OVER (ORDER BY doc_id) - 1) // ((SELECT count(*) FROM documents) // 8 + 1) AS BIGINT) AS shard
FROM documents"""

SQL["ordered_sink"] = """
SELECT o_orderkey, row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT), o_orderkey) - 1 AS position
FROM orders"""

SQL["jsonl_file_order"] = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents"

SQL["jsonl_offsets"] = """
SELECT doc_id, shard, CAST(coalesce(sum(n_bytes) OVER (PARTITION BY shard ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                           AS BIGINT) AS "offset", n_digits
FROM (SELECT doc_id, doc_id // 10000 AS shard, length(hex(coalesce(text, ''))) AS n_digits,
             length('{"doc_id":,"text":""}') + length(CAST(doc_id AS VARCHAR)) + length(hex(coalesce(text, ''))) + 1 AS n_bytes
      FROM documents) t"""

SQL["read_prompts"] = with_ctes(PROMPT_MSGS) + """
SELECT row_id, count(*) AS n_messages, CAST(sum(length(content)) AS BIGINT) AS n_chars FROM prompt_msgs GROUP BY row_id"""

_PADS = "[' ' || chr(9), chr(12288), '', chr(8232) || chr(10), chr(160) || ' ', chr(28)]"
_PADDED = f"({_PADS}[CAST((conv_id + turn) % 6 + 1 AS INTEGER)] || text || {BOS} || role || {_PADS}[CAST((conv_id + turn + 1) % 6 + 1 AS INTEGER)])"
SQL["render_padded"] = f"""
SELECT row_id, {rm_text('t', "chr(8195) || 'ok' || chr(160)")} AS rm_text
FROM (SELECT row_id, string_agg(p, '' ORDER BY turn) AS t
      FROM (SELECT conv_id AS row_id, turn, {piece('role', _PADDED, 'false')} AS p FROM conversations) x GROUP BY row_id) y"""

# rows by row_id mod 6: 0 as they are, 1 a NaN, 2 a null reward, 3 a reward too many, 4 null responses, 5 one response
SQL["pair_outcomes_broken"] = _outcomes_sql().replace("SELECT strategy, outcome, count(*) AS n FROM (", """
SELECT strategy, outcome, count(*) AS n FROM (
SELECT s.strategy, CASE r.row_id % 6 WHEN 1 THEN 'nan' WHEN 2 THEN 'nan' WHEN 5 THEN 'short' ELSE 'uneven' END AS outcome
FROM (SELECT DISTINCT row_id FROM scored_long) r
CROSS JOIN (SELECT unnest(['random', 'max_random', 'max_min', 'max_max', 'max_min_p']) AS strategy) s
WHERE r.row_id % 6 <> 0
UNION ALL SELECT strategy, outcome FROM (""").replace(") o GROUP BY", ") plain) o GROUP BY").replace(
    "ON b.row_id = p.row_id AND b.k = p.i1", "ON b.row_id = p.row_id AND b.k = p.i1 WHERE p.row_id % 6 = 0")

SQL["score_summary_nulls"] = SQL["score_summary"].replace("count(*) AS n, sum(reward) AS s, max(reward) AS mx", """
  count(*) AS n, sum(r) AS s, max(r) AS mx, count(r) AS m""").replace("FROM scored_long GROUP BY", """
  FROM (SELECT *, CASE WHEN row_id % 5 = 1 AND k = 0 THEN NULL ELSE reward END AS r FROM scored_long) q GROUP BY""").replace(
    "/ sum(n) FILTER", "/ sum(m) FILTER")

SQL["sanity_cut"] = "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100"
