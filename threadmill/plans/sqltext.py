"""Builders for the DuckDB (RE2) oracle SQL.

RE2 has no look-around and its ``\\b``/``\\w`` are ASCII, while the reference uses
Python ``re`` on str (Unicode). Detection patterns therefore spell word boundaries
as consuming classes, and replacements re-emit the consumed boundary characters.
"""

from __future__ import annotations

from threadmill.functions.domain import DOMAIN_RULES, REFUSAL_RE

W = r"[\p{L}\p{N}_]"            # Python \w on str
NW = r"[^\p{L}\p{N}_]"
WS = r"[\t-\r\x1c-\x1f\x85\p{Z}]"  # Python str.isspace()


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def detect_pattern(py: str) -> str:
    r"""Python pattern -> RE2 for detection/extraction: ``\b`` at an alternative's start
    is a leading boundary, anywhere else a trailing one (both consume a character);
    ``\w``, ``\s``, ``\d`` become explicit classes (inside ``[...]`` too)."""
    out = []
    i = 0
    in_class = False
    while i < len(py):
        two = py[i:i + 2]
        if two == r"\b" and not in_class:
            leading = i == 0 or py[i - 1] in "|("
            out.append(f"(?:^|{NW})" if leading else f"(?:{NW}|$)")
        elif two == r"\w":
            out.append(W[1:-1] if in_class else W)
        elif two == r"\s":
            out.append(WS[1:-1] if in_class else WS)
        elif two == r"\d":
            out.append("0-9" if in_class else "[0-9]")
        elif py[i] == "\\":
            out.append(two)
        else:
            if py[i] == "[" and not in_class:
                in_class = True
            elif py[i] == "]" and in_class and py[i - 1] != "[" and py[i - 2:i] != "[^":
                in_class = False
            out.append(py[i])
            i += 1
            continue
        i += 2
    return "".join(out)


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def nz(e: str) -> str:
    return f"nullif({e}, '')"


def words(e: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({e}, ''), {q(WS + '+')}), lambda t: t <> '')"


def word_count(e: str) -> str:
    return f"len({words(e)})"


# The scrub patterns of ``functions.scrub`` re-spelled for RE2.
_EMAIL = r"[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_KEY = r"sk-[A-Za-z0-9]{20,}|ghp_[A-Za-z0-9]{20,}|AKIA[0-9A-Z]{16}"
_SCRUB = [
    (r"\x1b\[[0-9;]*[A-Za-z]", ""),
    (r"(?s)<local-command-caveat>.*?</local-command-caveat>", ""),
    (r"(?s)<command-name>.*?</command-name>|<command-message>.*?</command-message>"
     r"|<command-args>.*?</command-args>", ""),
    (r"(?s)<local-command-stdout>.*?</local-command-stdout>", ""),
    (r"USER:" + WS + r"*Set model to.*?(?:\n|$)", ""),
    (r"/home/[^/" + WS[1:-1] + r"]+/", "/home/user/"),
    (r"[A-Za-z]:\\Users\\[^\\" + WS[1:-1] + r"]+\\", r"C:\\Users\\user\\"),
    # e-mail: a word-char start needs a non-word char (or start) before it, a
    # non-word start needs a word char before it; a letter ends it before a non-word.
    ("(^|" + NW + ")([A-Za-z0-9_]" + _EMAIL + ")(" + NW + "|$)|(" + W + ")([._%+-]" + _EMAIL
     + ")(" + NW + "|$)", r"\1\4user@example.com\3\6"),
    ("(^|" + NW + ")(" + _KEY + ")(" + NW + "|$)", r"\1<REDACTED_KEY>\3"),
]


def scrub(e: str) -> str:
    """P11 in RE2. The boundary-consuming rules run twice so that back-to-back
    matches sharing one separator are all rewritten (the rewrite is idempotent)."""
    out = f"coalesce({e}, '')"
    for i, (pat, repl) in enumerate(_SCRUB):
        passes = 2 if i >= 7 else 1
        for _ in range(passes):
            out = f"regexp_replace({out}, {q(pat)}, {q(repl)}, 'g')"
    return strip(out)


def refusal(e: str) -> str:
    return f"regexp_matches({e}, {q('(?i)' + detect_pattern(REFUSAL_RE))})"


def domain(e: str) -> str:
    parts = [f"WHEN regexp_matches(coalesce({e}, ''), {q('(?i)' + detect_pattern(p))}) THEN {q(n)}"
             for n, p in DOMAIN_RULES]
    return "CASE " + " ".join(parts) + " ELSE 'general' END"


def md5_key(seed: int | str, id_expr: str) -> str:
    return f"md5({q(str(seed) + ':')} || CAST({id_expr} AS VARCHAR))"


# ---------------------------------------------------------------------------
# Fixture CTEs (identical derivations to threadmill.plans.fixtures)
# ---------------------------------------------------------------------------

NOISY = (
    "noisy AS (SELECT doc_id, source, lang, CASE WHEN doc_id % 5 = 0 THEN text || ' /home/u' || "
    "CAST(doc_id AS VARCHAR) || '/x ' || chr(27) || '[31m' || '<command-name>run</command-name> sk-' || "
    "md5(CAST(doc_id AS VARCHAR)) ELSE text END AS text FROM documents)"
)
FLAT = (
    NOISY + ", flat AS (SELECT doc_id, source, substring(text, 1, 200) AS problem, "
    "substring(text, 201) AS solution, CASE WHEN doc_id % 2 = 1 THEN substring(text, 1, "
    "CAST(doc_id % 900 AS BIGINT)) END AS thinking FROM noisy)"
)
TAGGED = (
    "tagged AS (SELECT conv_id, turn, role, CASE WHEN conv_id % 11 = 0 AND turn = max(turn) OVER "
    "(PARTITION BY conv_id) THEN 'I cannot ' || t ELSE t END AS text FROM (SELECT conv_id, turn, role, "
    "CASE WHEN role <> 'assistant' THEN text WHEN conv_id % 7 = 0 THEN '<think>' || text "
    "WHEN conv_id % 3 = 0 THEN text ELSE '<think>' || substring(text, 1, 40) || '</think>' || "
    "substring(text, 41) END AS t, text FROM conversations))"
)


def messages_cte(name: str, turns: str, content: str = "text") -> str:
    return (f"{name} AS (SELECT conv_id, list(struct_pack(role := role, content := {content}) "
            f"ORDER BY turn) AS messages FROM {turns} GROUP BY conv_id)")


# ---------------------------------------------------------------------------
# Message helpers (DuckDB lists of structs; lambdas as ``lambda x: ...``)
# ---------------------------------------------------------------------------

def canon_role(e: str) -> str:
    from threadmill.functions.messages import ROLE_ALIASES
    low = f"lower(coalesce({e}, ''))"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ROLE_ALIASES.items())
    return f"CASE {low} {whens} ELSE {low} END"


_THINK = "(?s)<think>(.*?)</think>(.*)"


def think_trunc(e: str) -> str:
    return f"(contains(coalesce({e}, ''), '<think>') AND NOT contains(coalesce({e}, ''), '</think>'))"


def think_thinking(e: str) -> str:
    found = f"regexp_matches(coalesce({e}, ''), {q('(?s)<think>.*?</think>')})"
    inner = strip(f"regexp_extract(coalesce({e}, ''), {q(_THINK)}, 1)")
    return f"CASE WHEN NOT {think_trunc(e)} AND {found} THEN nullif({inner}, '') END"


def think_answer(e: str) -> str:
    found = f"regexp_matches(coalesce({e}, ''), {q('(?s)<think>.*?</think>')})"
    tail = strip(f"regexp_extract(coalesce({e}, ''), {q(_THINK)}, 2)")
    return f"CASE WHEN {think_trunc(e)} THEN NULL WHEN {found} THEN {tail} ELSE {strip('coalesce(' + e + ', \'\')')} END"


def render_chat(m: str, pre: str = "<|im_start|>", sep: str = "\n", suf: str = "<|im_end|>\n") -> str:
    return (f"array_to_string(list_transform({m}, lambda x: {q(pre)} || x.role || {q(sep)} || "
            f"coalesce(x.content, '') || {q(suf)}), '')")


CONV_NORM = (
    "conv AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m "
    "FROM tagged GROUP BY conv_id), "
    "b AS (SELECT conv_id, len(m) AS n_raw, list_transform(m, lambda x: struct_pack(role := "
    + canon_role("nullif(x.role, '')") + ", content := coalesce(nullif(x.content, ''), ''))) AS m FROM conv), "
    "l AS (SELECT *, list_max(list_transform(m, lambda x, i: CASE WHEN x.role = 'assistant' THEN i ELSE 0 END)) "
    "AS li FROM b), "
    "s AS (SELECT *, CASE WHEN li > 0 THEN m[li].content END AS lc FROM l), "
    "sp AS (SELECT *, " + think_thinking("lc") + " AS lt, " + think_answer("lc") + " AS la, "
    + think_trunc("lc") + " AS ltr FROM s), "
    "norm AS (SELECT conv_id, list_transform(m, lambda x, i: struct_pack(role := x.role, content := "
    "CASE WHEN i = li THEN coalesce(la, '') ELSE x.content END, thinking := CASE WHEN i = li THEN lt END)) AS m, "
    "(n_raw > 0 AND NOT coalesce(li > 0 AND ltr, false) AND list_bool_or(list_transform(m, lambda x: x.role = 'user')) "
    "AND list_bool_or(list_transform(m, lambda x: x.role = 'assistant'))) AS ok FROM sp)"
)


# ---------------------------------------------------------------------------
# Math answers (T2-T5) and rewards
# ---------------------------------------------------------------------------

def boxed_tail(e: str) -> str:
    return (f"CASE WHEN contains({e}, '\\boxed{{') THEN regexp_extract({e}, {q('(?s).*\\\\boxed\\{(.*)')}, 1) "
            f"WHEN contains({e}, '\\boxed {{') THEN regexp_extract({e}, {q('(?s).*\\\\boxed \\{(.*)')}, 1) END")


def close_pos(t: str) -> str:
    """1-based position of the brace closing depth 1 in ``t`` (0 if none)."""
    return (f"coalesce(list_position(list_transform(range(1, length({t}) + 1), lambda i: 1 + "
            f"length(replace(substring({t}, 1, i), '}}', '')) - length(replace(substring({t}, 1, i), '{{', ''))), 0), 0)")


def extract_boxed(e: str) -> str:
    t = boxed_tail(e)
    p = close_pos(t)
    return f"CASE WHEN ({t}) IS NOT NULL AND {p} > 0 THEN {strip(f'substring({t}, 1, {p} - 1)')} END"


def extract_answer(e: str, boxed: str | None = None) -> str:
    from threadmill.functions.answers import ANSWER_PATTERNS, TRAILING_NUMBER
    b = boxed or extract_boxed(e)
    parts = [f"nullif({b}, '')"]
    for p in ANSWER_PATTERNS + [TRAILING_NUMBER]:
        r = q(detect_pattern(p))
        parts.append(f"CASE WHEN regexp_matches({e}, {r}) THEN {strip(f'regexp_extract({e}, {r}, 1)')} END")
    return f"CASE WHEN {e} IS NULL OR {e} = '' THEN NULL ELSE coalesce({', '.join(parts)}) END"


def normalize_answer(e: str) -> str:
    from threadmill.functions.answers import NORMALIZE_RULES
    out = f"lower({strip(e)})"
    for p, r in NORMALIZE_RULES:
        out = f"regexp_replace({out}, {q(detect_pattern(p))}, {q(r.replace('$', chr(92)))}, 'g')"
    out = f"array_to_string({words(out)}, ' ')"
    return f"CASE WHEN {e} IS NULL OR {e} = '' THEN '' ELSE {out} END"


def py_float(e: str) -> str:
    from threadmill.functions.answers import FLOAT_RE
    t = strip(e)
    low = f"lower({t})"
    return (f"CASE WHEN regexp_matches({t}, {q(FLOAT_RE)}) THEN CASE WHEN {low} IN ('inf', '+inf', 'infinity', "
            f"'+infinity') THEN 'inf'::DOUBLE WHEN {low} IN ('-inf', '-infinity') THEN '-inf'::DOUBLE "
            f"WHEN {low} IN ('nan', '+nan', '-nan') THEN 'nan'::DOUBLE ELSE TRY_CAST(replace({t}, '_', '') AS DOUBLE) "
            f"END END")


def try_parse_number(e: str) -> str:
    t = strip(e)
    parts = f"string_split({t}, '/')"
    a, b = py_float(f"{parts}[1]"), py_float(f"{parts}[2]")
    frac = f"CASE WHEN contains({t}, '/') AND len({parts}) = 2 AND ({b}) <> 0 THEN ({a}) / ({b}) END"
    return f"coalesce({py_float(t)}, {frac})"


def reward_parts(c: str) -> dict[str, str]:
    from threadmill.functions.rewards import REASONING_GROUPS, STEP_WORDS_RE
    fmt = (f"least((CASE WHEN regexp_matches(coalesce({c}, ''), {q(chr(92) * 2 + 'boxed' + chr(92) + '{')}) THEN 0.5 "
           f"ELSE 0.0 END) + (CASE WHEN regexp_matches(lower(coalesce({c}, '')), {q(detect_pattern(STEP_WORDS_RE))}) "
           f"THEN 0.3 ELSE 0.0 END) + (CASE WHEN regexp_matches(coalesce({c}, ''), '[=+\\-*/^]') THEN 0.2 "
           f"ELSE 0.0 END), 1.0)")
    n = word_count(c)
    length = (f"CASE WHEN {n} < 10 THEN 0.0 WHEN {n} < 30 THEN 0.3 WHEN {n} < 100 THEN 0.7 WHEN {n} < 300 "
              f"THEN 1.0 ELSE 0.8 END")
    terms = []
    for w, cues in REASONING_GROUPS:
        hit = " OR ".join(f"contains(lower(coalesce({c}, '')), {q(x)})" for x in cues)
        terms.append(f"(CASE WHEN {hit} THEN {w} ELSE 0.0 END)")
    rsn = f"least({' + '.join(terms)}, 1.0)"
    return {"fmt": fmt, "len": length, "rsn": rsn}


def accuracy(p: str, g: str, pn: str, gn: str, pnum: str, gnum: str) -> str:
    return (f"CASE WHEN coalesce({p}, '') <> '' AND coalesce({g}, '') <> '' THEN CASE WHEN {pn} = {gn} THEN 1.0 "
            f"WHEN contains({gn}, {pn}) OR contains({pn}, {gn}) THEN 0.7 WHEN {pnum} IS NOT NULL AND {gnum} IS NOT "
            f"NULL AND abs({pnum} - {gnum}) < 1e-6 THEN 1.0 ELSE 0.0 END WHEN coalesce({p}, '') <> '' THEN 0.3 "
            f"ELSE 0.0 END")


MATH = (
    "math AS (SELECT p_partkey, '<|user|>Part ' || CAST(p_partkey % 1500 AS VARCHAR) || '<|end|>' AS problem, "
    "CASE p_partkey % 5 WHEN 0 THEN p_name || '. We compute the total. The answer is \\boxed{\\frac{' || "
    "CAST(p_size AS VARCHAR) || '}{2}}' WHEN 1 THEN p_name || '. Therefore the answer is ' || CAST(p_size AS VARCHAR) "
    "|| '.' WHEN 2 THEN p_name || ' first \\boxed{' || CAST(p_size AS VARCHAR) || '} then \\boxed{' || "
    "CAST(p_size + 1 AS VARCHAR) || '}' WHEN 3 THEN p_name || ' \\boxed{' || CAST(p_size AS VARCHAR) || ' unbalanced' "
    "ELSE p_name || ' gives x = ' || CAST(p_size AS VARCHAR) END AS solution FROM part)"
)
COMPLETIONS = (
    "completions AS (SELECT p_partkey, '<|user|>Part ' || CAST(p_partkey % 1500 AS VARCHAR) || '<|end|>' AS prompt, "
    "CASE p_partkey % 6 WHEN 0 THEN 'Let us solve step 1 first. Therefore we get \\boxed{\\frac{' || "
    "CAST(p_size AS VARCHAR) || '}{2}}' WHEN 1 THEN 'Since the total is known, the result is \\boxed{' || "
    "CAST(p_size // 2 AS VARCHAR) || '.' || CAST((p_size % 2) * 5 AS VARCHAR) || '}' WHEN 2 THEN 'The answer is ' || "
    "CAST(p_size AS VARCHAR) || '0 because of the sum' WHEN 3 THEN 'I don''t know the answer to this problem.' "
    "WHEN 4 THEN 'No idea here' ELSE 'So, the answer is ' || CAST(p_size AS VARCHAR) END AS completion FROM part)"
)


TRACE_META = (
    "trace_meta AS (SELECT event_id, event_type AS first_source_dataset, CASE event_id % 4 WHEN 0 THEN "
    "'{\"messages\": [{\"role\": \"user\", \"content\": \"Event ' || CAST(event_id AS VARCHAR) || ' ' || event_type || "
    "'\"}, ' || CASE WHEN event_id % 8 = 0 THEN '{\"role\": \"assistant\", \"content\": \"\", \"tool_calls\": "
    "[{\"function\": {\"name\": \"Bash\", \"arguments\": \"{\\\"cmd\\\": \\\"ls /home/alice/\\\"}\"}}]}' "
    "ELSE '{\"role\": \"assistant\", \"content\": \"value ' || CAST(user_id AS VARCHAR) || '\", "
    "\"reasoning_content\": \"' || repeat('r', CAST(event_id % 600 AS INTEGER)) || '\"}' END || ']}' "
    "WHEN 1 THEN '{\"prompt\": \"Event ' || CAST(event_id AS VARCHAR) || '\", \"response\": \"' || event_type || "
    "' by user ' || CAST(user_id AS VARCHAR) || '\", \"category\": \"' || CASE WHEN user_id % 10 = 0 THEN 'decoy' "
    "ELSE 'real' END || '\"}' WHEN 2 THEN '{\"query\": \"Q' || CAST(event_id AS VARCHAR) || '\", \"thinking\": \"' || "
    "repeat('t', CAST(event_id % 1000 AS INTEGER)) || '\"}' ELSE '{\"broken\": ' || CAST(event_id AS VARCHAR) END "
    "AS row_json FROM events)"
)
