"""DuckDB SQL for the queries, written independently of the Spark expressions.

Statements are assembled from named common table expressions; each states the job in the most direct SQL,
without regard for scale.
"""

from __future__ import annotations

from rollout_quality.config import DEFAULT_SYSTEM_PROMPT
from rollout_quality.schemas import PUBLIC_FIELDS

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
FRACTION = rf"(-?[0-9]+){WS}*/{WS}*(-?[0-9]+)"
NUMBER = {
    "compat": r"-?[0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]+)?",
    "full": r"-?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?",
}
WORDS = "['zero','one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve']"
SYSTEM = DEFAULT_SYSTEM_PROMPT.replace("'", "''")
PAIR = "train__test"
SPLITS = "(VALUES (0, 'train'), (1, 'test')) AS s(ord, split)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def words(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> ''))"


def sentences(x: str) -> str:
    parts = rf"string_split(regexp_replace({x}, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))"
    return f"len(list_filter({parts}, lambda p: {strip('p')} <> ''))"


def bucket(x: str) -> str:
    n = sentences(x)
    return f"CASE WHEN {n} < 5 THEN 'easy' WHEN {n} < 10 THEN 'medium' ELSE 'hard' END"


def number_text(v: str) -> str:
    return f"CASE WHEN {v} = trunc({v}) THEN CAST(TRY_CAST({v} AS HUGEINT) AS VARCHAR) ELSE CAST({v} AS VARCHAR) END"


def fraction_value(f: str) -> str:
    a = f"TRY_CAST(regexp_extract({f}, '{FRACTION}', 1) AS DOUBLE)"
    b = f"TRY_CAST(regexp_extract({f}, '{FRACTION}', 2) AS DOUBLE)"
    return f"{a} / NULLIF({b}, 0)"


def fraction_text(v: str) -> str:
    return f"CASE WHEN {v} = trunc({v}) THEN CAST(TRY_CAST({v} AS HUGEINT) AS VARCHAR) ELSE format('{{:.6g}}', {v}) END"


def normalise(x: str, p: str, grammar: str = "compat") -> str:
    """Select-list items that end in `{p}out`, the canonical number text of expression `x`."""
    return f"""{strip(x)} AS {p}raw,
      regexp_extract({p}raw, '{FRACTION}', 0) AS {p}f,
      {fraction_value(p + 'f')} AS {p}fv,
      replace(regexp_extract({p}raw, '{NUMBER[grammar]}', 0), ',', '') AS {p}n,
      TRY_CAST({p}n AS DOUBLE) AS {p}nv,
      list_position({WORDS}, lower(trim(lower({p}raw), '.,!? '))) - 1 AS {p}w,
      CASE WHEN {p}f <> '' THEN {fraction_text(p + 'fv')}
           WHEN {p}n <> '' THEN {number_text(p + 'nv')}
           WHEN {p}w >= 0 THEN CAST({p}w AS VARCHAR) END AS {p}out"""


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


# ---- common table expressions ---------------------------------------------------------------------------

QA = """qa AS (
    SELECT doc_id AS src_id, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, text AS question,
      CASE WHEN doc_id % 12 = 6 THEN text ELSE concat(text, chr(10), '#### ', CASE doc_id % 12
        WHEN 0 THEN CAST(n_chars AS VARCHAR)
        WHEN 1 THEN concat('$', CAST(1 + n_chars % 900 AS VARCHAR), ',', lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0'))
        WHEN 2 THEN concat('-', CAST(doc_id % 100 AS VARCHAR))
        WHEN 3 THEN concat(CAST(doc_id % 7 + 1 AS VARCHAR), '/', CAST(doc_id % 9 AS VARCHAR))
        WHEN 4 THEN concat(CAST(doc_id % 101 AS VARCHAR), '%')
        WHEN 5 THEN 'Twelve.'
        WHEN 7 THEN 'no number here'
        WHEN 8 THEN concat(CAST(doc_id % 50 AS VARCHAR), '.50')
        WHEN 9 THEN '0'
        WHEN 10 THEN '1,024.75'
        WHEN 11 THEN concat('-$', CAST(doc_id % 30 AS VARCHAR)) END) END AS answer
    FROM documents)"""

IDX = "idx AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY src_id) - 1 AS idx FROM qa)"

PARSED = f"""parsed AS (
    SELECT *, strpos(answer, '####') AS at_, substr(answer, at_ + 4) AS tail_,
      {normalise('tail_', 'a_')},
      CASE WHEN at_ = 0 THEN concat('parse_error:No ''####'' found in solution: ', substr(answer, 1, 80))
           WHEN a_out IS NULL THEN concat('parse_error:Cannot parse numeric answer from: ''', a_raw, '''') END
        AS parse_error,
      CASE WHEN at_ = 0 THEN 'no_marker' WHEN a_out IS NULL THEN 'unparseable_answer' END AS parse_code,
      CASE WHEN parse_error IS NULL THEN a_out END AS reference_answer,
      CASE WHEN parse_error IS NULL THEN {strip('substr(answer, 1, at_ - 1)')} END AS reference_solution
    FROM idx)"""

PROC = f"""proc AS (
    SELECT idx, src_id, split, question,
      CASE WHEN {strip('question')} = '' THEN 'empty_question;empty_prompt_content:1' END AS invalid,
      coalesce(parse_error, invalid) AS error,
      coalesce(parse_code, CASE WHEN invalid IS NOT NULL THEN 'empty_question' END) AS error_code,
      CASE WHEN error IS NULL THEN reference_answer END AS reference_answer,
      CASE WHEN error IS NULL THEN reference_solution END AS reference_solution,
      CASE WHEN error IS NULL THEN {bucket('reference_solution')} END AS difficulty,
      CASE WHEN error IS NULL THEN idx END AS original_idx,
      CASE WHEN error IS NULL THEN 'system' END AS role_0,
      CASE WHEN error IS NULL THEN '{SYSTEM}' END AS content_0,
      CASE WHEN error IS NULL THEN 'user' END AS role_1,
      CASE WHEN error IS NULL THEN {strip('question')} END AS content_1,
      CASE WHEN error IS NULL THEN {words("content_0 || ' ' || content_1")} END AS n_words,
      CASE WHEN contains(reference_answer, '/') THEN 'fraction' WHEN contains(reference_answer, '.') THEN 'decimal'
           WHEN starts_with(reference_answer, '-') THEN 'negative_integer'
           WHEN reference_answer IS NOT NULL THEN 'integer' END AS answer_type
    FROM parsed)"""

PREP = (QA, IDX, PARSED, PROC)
RECORD = (
    "idx, split, question, reference_answer, role_0, content_0, role_1, content_1, original_idx, difficulty"
)

FP = f"""fp AS (
    SELECT split, regexp_replace({strip('lower(question)')}, '{WS}+', ' ', 'g') AS fingerprint
    FROM proc WHERE error IS NULL)"""

DUP = """dup AS (
    SELECT s.ord, s.split, coalesce(sum(c - 1), 0) AS duplicate_count
    FROM """ + SPLITS + """ LEFT JOIN (SELECT split, fingerprint, count(*) AS c FROM fp GROUP BY ALL) f
      ON f.split = s.split GROUP BY ALL)"""

SHARED = """shared AS (
    SELECT DISTINCT a.fingerprint FROM fp a JOIN fp b ON a.fingerprint = b.fingerprint
    WHERE a.split = 'train' AND b.split = 'test')"""

COMP = """comp AS (
    SELECT doc_id AS prompt_id, CAST(g AS BIGINT) AS gen_idx, CAST(n_chars % 900 AS VARCHAR) AS reference,
      CASE g WHEN 0 THEN concat(text, chr(10), '#### ', CAST(n_chars % 900 AS VARCHAR))
             WHEN 1 THEN concat(text, chr(10), '#### ', CAST(n_chars % 900 + doc_id % 3 AS VARCHAR))
             WHEN 2 THEN concat(text, ' so the answer is ', CAST(n_chars % 900 AS VARCHAR), '.')
             ELSE text END AS completion
    FROM documents, range(4) AS r(g))"""


def feat(grammar: str = "compat") -> str:
    return f"""feat AS (
    SELECT prompt_id, gen_idx, reference, completion, contains(completion, '####') AS marked,
      string_split(completion, '####')[-1] AS after_,
      {normalise('after_', 'm_', grammar)},
      list_filter(list_transform(regexp_extract_all(completion, '{FRACTION}', 0), lambda f: {fraction_value('f')}),
        lambda v: v IS NOT NULL)[-1] AS last_f,
      TRY_CAST(replace(regexp_extract_all(completion, '{NUMBER[grammar]}', 0)[-1], ',', '') AS DOUBLE) AS last_n,
      coalesce(CASE WHEN marked THEN m_out END, {fraction_text('last_f')}, {number_text('last_n')}) AS predicted,
      CASE WHEN marked THEN 0.4 ELSE 0.0 END
        + CASE WHEN len(list_filter(string_split_regex(completion, '{BREAK}'), lambda l: {strip('l')} <> '')) >= 3
               THEN 0.3 ELSE 0.0 END
        + CASE WHEN marked AND regexp_matches(after_, '[0-9]') THEN 0.3 ELSE 0.0 END AS format_,
      {words('completion')} AS n_words,
      CASE WHEN n_words < 20 THEN n_words / 20.0 WHEN n_words > 512 THEN 512.0 / n_words ELSE 1.0 END AS length_,
      TRY_CAST(predicted AS DOUBLE) AS p, TRY_CAST(reference AS DOUBLE) AS r,
      CAST(CASE WHEN p IS NULL OR r IS NULL THEN 0
           WHEN abs(p - r) <= 1e-6 * greatest(abs(p), abs(r)) THEN 1 ELSE 0 END AS DOUBLE) AS exact_,
      CASE WHEN p IS NULL OR r IS NULL THEN 0.0 ELSE exp(-0.1 * abs(p - r) / (abs(r) + 1)) END AS soft_,
      least((exact_ + 0.3 * soft_ + 0.2 * CAST(format_ AS DOUBLE) + 0.1 * CAST(length_ AS DOUBLE)) / 1.6, 1.0)
        AS reward
    FROM comp)"""


FEAT = feat()
SCORE = (COMP, FEAT)
LABELLED = """labelled AS (
    SELECT f.*, coalesce(p.difficulty, 'unknown') AS difficulty FROM feat f LEFT JOIN proc p ON p.src_id = f.prompt_id)"""
EVALUATE = (*PREP, *SCORE, LABELLED)

ADVANTAGE = """adv AS (
    SELECT prompt_id, gen_idx, reference, completion, reward,
      (reward - avg(reward) OVER w) / (stddev_pop(reward) OVER w + 1e-8) AS advantage
    FROM feat WINDOW w AS (PARTITION BY prompt_id))"""

REPORT = f"""rep AS (
    SELECT s.ord, s.split,
      count(*) FILTER (p.idx IS NOT NULL AND error IS NULL) AS record_count,
      count(*) FILTER (error IS NOT NULL) AS failed_count,
      count(p.idx) AS raw_count,
      count(*) FILTER (difficulty = 'easy') AS difficulty_easy,
      count(*) FILTER (difficulty = 'medium') AS difficulty_medium,
      count(*) FILTER (difficulty = 'hard') AS difficulty_hard,
      count(*) FILTER (answer_type = 'fraction') AS answer_fraction,
      count(*) FILTER (answer_type = 'decimal') AS answer_decimal,
      count(*) FILTER (answer_type = 'negative_integer') AS answer_negative_integer,
      count(*) FILTER (answer_type = 'integer') AS answer_integer,
      CAST(coalesce(min(n_words), 0) AS BIGINT) AS min_words,
      CAST(coalesce(max(n_words), 0) AS BIGINT) AS max_words,
      coalesce(avg(n_words), 0.0) AS mean_words,
      count(*) FILTER (n_words > 512) AS truncation_risk_count,
      CAST(count(*) FILTER (error IS NULL) - count(DISTINCT content_1) FILTER (error IS NULL) AS BIGINT)
        AS duplicate_prompt_count
    FROM {SPLITS} LEFT JOIN proc p ON p.split = s.split GROUP BY ALL)"""


def sql(ctes: tuple[str, ...], select: str) -> str:
    return f"WITH {', '.join(ctes)}\n{select}"


def _records(ctes: tuple[str, ...] = PREP, extra: str = "", where: str = "error IS NULL") -> str:
    return sql(ctes, f"SELECT {RECORD}{extra} FROM proc WHERE {where}")


def _per_completion(columns: str, ctes: tuple[str, ...] = SCORE, source: str = "feat") -> str:
    return sql(ctes, f"SELECT prompt_id, gen_idx, {columns} FROM {source}")


_METRICS = f"""count(*) AS n, {r6('avg(exact_)')} AS accuracy, {r6('avg(reward)')} AS mean_reward"""
_ROLLUP = sql(
    EVALUATE,
    f"""SELECT CASE WHEN grouping(difficulty) = 1 THEN 'all' ELSE difficulty END AS difficulty,
      CAST(grouping(difficulty) AS BIGINT) AS level, {_METRICS}, {r6('avg(format_)')} AS mean_format
    FROM labelled GROUP BY ROLLUP (difficulty)""",
)
_BY_DIFFICULTY = sql(EVALUATE, f"SELECT difficulty, {_METRICS} FROM labelled GROUP BY difficulty")
_ADVANTAGES = _per_completion(f"{r6('advantage')} AS advantage", (*SCORE, ADVANTAGE), "adv")
_REWARD = _per_completion(f"{r6('reward')} AS reward")
_QA_ONLY = (QA, "idx AS (SELECT *, 0 AS idx FROM qa)", PARSED)
_INDEX = sql((QA, IDX), "SELECT src_id, split, idx FROM idx")
_RL_VIEW = "SELECT content_0 AS system, content_1 AS user, reference_answer FROM proc WHERE error IS NULL"
_REPORT_COLUMNS = """split, record_count, failed_count, raw_count, difficulty_easy, difficulty_medium, difficulty_hard,
      answer_fraction, answer_decimal, answer_negative_integer, answer_integer, min_words, max_words,
      CAST(printf('%.2f', mean_words) AS DOUBLE) AS avg_words, truncation_risk_count, duplicate_prompt_count"""
_TAIL = "CASE WHEN contains(answer, '####') THEN string_split(answer, '####')[-1] ELSE answer END"


def _normalised(grammar: str) -> str:
    return sql(
        (
            QA,
            f"n AS (SELECT src_id, {normalise(_TAIL, 'a_', grammar)}, {normalise('question', 'q_', grammar)} FROM qa)",
        ),
        "SELECT src_id, a_out AS answer_number, q_out AS question_number FROM n",
    )


_VALIDATE = f"""
    SELECT doc_id AS expected_idx, array_to_string(list_filter([
      CASE WHEN doc_id % 10 = 1 THEN 'unstable_idx' END,
      CASE WHEN doc_id % 10 = 2 OR {strip('text')} = '' THEN 'empty_question' END,
      CASE WHEN doc_id % 10 = 3 THEN 'invalid_reference_answer' END,
      CASE WHEN doc_id % 10 = 9 THEN 'invalid_metadata' END,
      CASE WHEN doc_id % 10 IN (4, 8) THEN 'invalid_prompt_messages' END,
      CASE WHEN doc_id % 10 IN (5, 7) THEN 'invalid_prompt_roles' END,
      CASE WHEN doc_id % 10 = 7 THEN 'prompt_message_not_dict:0' END,
      CASE WHEN doc_id % 10 = 6 THEN 'empty_prompt_content:0' END,
      CASE WHEN doc_id % 10 = 5 AND {strip('text')} = '' THEN 'empty_prompt_content:0' END,
      CASE WHEN doc_id % 10 NOT IN (4, 5, 8) AND {strip('text')} = '' THEN 'empty_prompt_content:1' END
    ], lambda e: e IS NOT NULL), ';') AS errors FROM documents"""

_GATES = f"""
    SELECT CAST(ord * 3 AS BIGINT) AS seq, split AS scope, 'parse_error_rate' AS rule,
      concat(split, ' parse/drop rate ', printf('%.4f', failed_count / greatest(raw_count, 1)),
        ' exceeds max_parse_error_rate=0.0100') AS message
    FROM rep WHERE failed_count / greatest(raw_count, 1) > 0.01
    UNION ALL
    SELECT ord * 3 + 1, split, 'duplicate_prompts', concat(split, ' has ', duplicate_prompt_count, ' duplicate prompt(s)')
    FROM rep WHERE duplicate_prompt_count > 0
    UNION ALL
    SELECT ord * 3 + 2, split, 'truncation_risk', concat(split, ' truncation risk rate ',
      printf('%.4f', truncation_risk_count / greatest(record_count, 1)), ' (', truncation_risk_count, '/', record_count,
      ' prompts) exceeds max_truncation_risk_rate=0.0000')
    FROM rep WHERE truncation_risk_count / greatest(record_count, 1) > 0
    UNION ALL
    SELECT 6 + ord, split, 'within_split_duplicates',
      concat(split, ' has ', CAST(duplicate_count AS BIGINT), ' duplicate question(s) within split')
    FROM dup WHERE duplicate_count > 0
    UNION ALL
    SELECT 8, '{PAIR}', 'cross_split_leakage',
      concat('cross-split leakage detected in {PAIR}: ', count(*), ' duplicate question(s)')
    FROM shared HAVING count(*) > 0"""

_LEAKAGE = f"""
    SELECT 'within_split' AS kind, split AS scope, CAST(duplicate_count AS BIGINT) AS duplicate_count, '' AS examples
    FROM dup
    UNION ALL
    SELECT 'pair', '{PAIR}', count(*), coalesce(array_to_string(list_slice(list_sort(list(fingerprint)), 1, 5), '|'), '')
    FROM shared"""

_CONTRACT = """'v1' AS contract_version, CAST(1.0 AS DOUBLE) AS exact_match_weight,
      CAST(0.3 AS DOUBLE) AS soft_numeric_weight, CAST(0.2 AS DOUBLE) AS format_weight,
      CAST(0.1 AS DOUBLE) AS length_weight, CAST(0.1 AS DOUBLE) AS soft_reward_k,
      CAST(20 AS BIGINT) AS min_completion_tokens, CAST(512 AS BIGINT) AS max_completion_tokens,
      'prefer_####_then_last_numeric' AS answer_extraction_policy,
      'currency_commas_percent_fraction_word_numbers' AS normalization_policy"""


def oracles() -> dict[str, str]:
    leak = (*PREP, FP, DUP, SHARED)
    return {
        "evaluate": _ROLLUP,
        "join_references": _per_completion("reference, predicted"),
        "extract_answers": _per_completion("predicted"),
        "extract_answers_full": _per_completion("predicted", (COMP, feat("full"))),
        "exact_match": _per_completion("exact_ AS exact_match"),
        "eval_summary": sql(
            SCORE,
            f"""SELECT count(*) AS num_samples, {r6('coalesce(avg(exact_), 0)')} AS exact_match_accuracy,
              {r6('coalesce(avg(reward), 0)')} AS mean_composite_reward,
              {r6('coalesce(avg(format_), 0)')} AS mean_format_reward FROM feat""",
        ),
        "soft_numeric": _per_completion(f"{r6('soft_')} AS soft_numeric"),
        "format_reward": _per_completion(f"{r6('CAST(format_ AS DOUBLE)')} AS format"),
        "length_reward": _per_completion(f"{r6('CAST(length_ AS DOUBLE)')} AS length"),
        "composite_reward": _REWARD,
        "selected_reward": _per_completion(
            f"{r6('least((2.0 * exact_ + 0.25 * CAST(format_ AS DOUBLE)) / CAST(2.25 AS DOUBLE), 1.0)')} AS reward"
        ),
        "reward_matrix": _per_completion(
            f"""exact_ AS exact_match, {r6('soft_')} AS soft_numeric, {r6('CAST(format_ AS DOUBLE)')} AS format,
              {r6('CAST(length_ AS DOUBLE)')} AS length,
              {r6('exact_ + soft_ + CAST(format_ AS DOUBLE) + CAST(length_ AS DOUBLE)')} AS reward_sum,
              {r6('exact_ + 0.3 * soft_ + 0.2 * CAST(format_ AS DOUBLE) + 0.1 * CAST(length_ AS DOUBLE)')}
                AS weighted_sum"""
        ),
        "group_rewards": _REWARD,
        "custom_reward": _per_completion(
            f"""CASE WHEN contains(completion, concat('#### ', reference)) THEN 1.0
              ELSE {r6('CAST(1.0 AS DOUBLE) / (length(completion) + 1)')} END AS reward""",
            (COMP,),
            "comp",
        ),
        "multi_reward": sql(
            (
                *SCORE,
                """m AS (SELECT prompt_id, gen_idx, CAST(format_ AS DOUBLE) AS f, CAST(length_ AS DOUBLE) AS l,
                   CASE WHEN contains(completion, reference) THEN CAST(1 AS DOUBLE) ELSE 0 END AS c FROM feat)""",
            ),
            f"""SELECT prompt_id, gen_idx, {r6('f')} AS format, {r6('l')} AS length, c AS mentions,
              {r6('f + l + c')} AS reward_sum, {r6('0.5 * f + l + 2.0 * c')} AS weighted_sum FROM m""",
        ),
        "group_advantages": _ADVANTAGES,
        "group_advantages_blocked": _ADVANTAGES,
        "group_advantages_hot": sql(
            SCORE,
            f"""SELECT prompt_id, gen_idx, source, {r6('''(reward - avg(reward) OVER w)
              / (stddev_pop(reward) OVER w + 1e-8)''')} AS advantage
            FROM feat JOIN documents ON doc_id = prompt_id WINDOW w AS (PARTITION BY source)""",
        ),
        "group_step": _per_completion(
            f"""reference, md5(completion) AS completion_md5, {r6('reward')} AS reward,
              {r6('advantage')} AS advantage""",
            (*SCORE, ADVANTAGE),
            "adv",
        ),
        "group_step_arrays": _per_completion(
            f"{r6('reward')} AS reward, {r6('advantage')} AS advantage", (*SCORE, ADVANTAGE), "adv"
        ),
        "reward_contract": _per_completion(f"{r6('reward')} AS reward, {_CONTRACT}"),
        "completion_text": """SELECT conv_id, turn, CASE WHEN role = 'system' THEN '' ELSE text END AS completion
            FROM conversations""",
        "eval_by_difficulty": _BY_DIFFICULTY,
        "eval_rollup": _ROLLUP,
        "eval_sample": sql(
            PREP,
            """SELECT idx, split, question, reference_answer FROM proc WHERE error IS NULL AND split = 'test'
            ORDER BY idx LIMIT 100""",
        ),
        "load_qa": sql((QA,), "SELECT src_id, split, question, answer FROM qa"),
        "load_qa_counts": sql((QA,), "SELECT split, count(*) AS n_rows FROM qa GROUP BY split"),
        "index_split": _INDEX,
        "index_split_bucketed": _INDEX,
        "index_split_ties": """WITH sized AS (
              SELECT doc_id, lang AS split, CAST(length(CAST(n_chars AS VARCHAR)) AS BIGINT) AS size_class FROM documents)
            SELECT doc_id, split, size_class, row_number() OVER (
              PARTITION BY split ORDER BY size_class NULLS FIRST, doc_id NULLS FIRST) - 1 AS idx FROM sized""",
        "parse_solutions": sql(
            _QA_ONLY,
            """SELECT src_id, reference_solution, reference_answer, parse_error AS error, parse_code AS error_code
            FROM parsed""",
        ),
        "normalise_answers": _normalised("compat"),
        "normalise_answers_full": _normalised("full"),
        "build_prompts": sql(
            (QA,),
            f"""SELECT src_id, CAST(2 AS BIGINT) AS n_messages, 'system' AS role_0, '{SYSTEM}' AS content_0,
              'user' AS role_1, {strip('question')} AS content_1 FROM qa""",
        ),
        "difficulty_buckets": sql(
            _QA_ONLY,
            f"""SELECT src_id, CASE WHEN reference_solution IS NOT NULL THEN {bucket('reference_solution')} END
              AS difficulty, {bucket(strip('question'))} AS question_difficulty FROM parsed""",
        ),
        "question_fingerprints": sql(
            (QA,),
            f"SELECT src_id, regexp_replace({strip('lower(question)')}, '{WS}+', ' ', 'g') AS fingerprint FROM qa",
        ),
        "prompt_lengths": sql(
            (QA,), f"SELECT src_id, {words(f"concat('{SYSTEM}', ' ', question)")} AS words FROM qa"
        ),
        "answer_types": sql(
            PREP, "SELECT src_id, reference_answer, answer_type FROM proc WHERE reference_answer IS NOT NULL"
        ),
        "process_split": _records(extra=", reference_solution, error, error_code", where="true"),
        "validate_records": _VALIDATE,
        "quarantine": sql(
            PREP, "SELECT idx, split, question, error, error_code FROM proc WHERE error IS NOT NULL"
        ),
        "trainer_view": _records(),
        "analysis_view": _records(extra=", reference_solution"),
        "rl_input_view": sql(PREP, _RL_VIEW),
        "filter_difficulty": _records(where="difficulty = 'medium'"),
        "batch_plan": sql(
            (
                *PREP,
                """placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY idx) - 1 AS position
                   FROM proc WHERE error IS NULL)""",
            ),
            """SELECT split, position // 32 AS batch_no, count(*) AS batch_size, min(idx) AS first_idx,
              max(idx) AS last_idx, max(n_words) AS max_words FROM placed GROUP BY ALL""",
        ),
        "batch_shuffle": sql(
            PREP,
            """SELECT split, CAST(ceil(count(*) / 32.0) AS BIGINT) AS batches, count(*) AS n_rows,
              least(count(*), 32) AS largest, count(*) - 32 * (CAST(ceil(count(*) / 32.0) AS BIGINT) - 1) AS smallest,
              CAST(sum(idx) AS BIGINT) AS sum_idx
            FROM proc WHERE error IS NULL GROUP BY split""",
        ),
        "batch_steps": sql(
            PREP,
            """SELECT split, count(*) AS n_rows, CAST(ceil(count(*) / 32.0) AS BIGINT) AS steps
            FROM proc WHERE error IS NULL GROUP BY split""",
        ),
        "render_prompts": sql(
            PREP,
            """SELECT idx, split, concat('[SYSTEM]', chr(10), content_0, chr(10), chr(10), '[USER]', chr(10), content_1,
              chr(10), chr(10), '[ASSISTANT]') AS prompt FROM proc WHERE error IS NULL""",
        ),
        "failure_reasons": sql(
            PREP, "SELECT split, error, error_code, count(*) AS n FROM proc WHERE error IS NOT NULL GROUP BY ALL"
        ),
        "split_counts": sql(
            (*PREP, REPORT),
            f"""SELECT split, record_count, failed_count, raw_count,
              {r6('failed_count / greatest(raw_count, 1)')} AS error_rate FROM rep""",
        ),
        "difficulty_distribution": sql(
            PREP, "SELECT split, difficulty, count(*) AS n FROM proc WHERE difficulty IS NOT NULL GROUP BY ALL"
        ),
        "answer_type_distribution": sql(
            PREP, "SELECT split, answer_type, count(*) AS n FROM proc WHERE error IS NULL GROUP BY ALL"
        ),
        "prompt_length_summary": sql(
            (*PREP, REPORT),
            f"""SELECT split, min_words, max_words, {r6('mean_words')} AS avg_words, truncation_risk_count FROM rep""",
        ),
        "duplicate_prompts": sql((*PREP, REPORT), "SELECT split, duplicate_prompt_count FROM rep"),
        "split_report": sql((*PREP, REPORT), f"SELECT {_REPORT_COLUMNS} FROM rep"),
        "within_split_duplicates": sql(
            (*PREP, FP, DUP), "SELECT split, CAST(duplicate_count AS BIGINT) AS duplicate_count FROM dup"
        ),
        "cross_split_overlap": sql(leak, f"SELECT '{PAIR}' AS pair, count(*) AS duplicate_count FROM shared"),
        "overlap_examples": sql(
            leak,
            f"""SELECT '{PAIR}' AS pair, row_number() OVER (ORDER BY fingerprint) AS rank, fingerprint AS question
            FROM shared ORDER BY fingerprint LIMIT 5""",
        ),
        "fingerprint_intersect": sql(
            leak,
            """SELECT fingerprint AS question FROM fp WHERE split = 'train'
            INTERSECT SELECT fingerprint FROM fp WHERE split = 'test'""",
        ),
        "leakage_report": sql(leak, _LEAKAGE),
        "quality_gates": sql((*leak, REPORT), _GATES),
        "dataset_summary": sql(
            PREP,
            f"""SELECT split, count(*) AS n_rows, '{",".join(PUBLIC_FIELDS)}' AS columns, min(idx) AS first_idx,
              arg_min(question, idx) AS first_question, arg_min(reference_answer, idx) AS first_answer,
              arg_min(difficulty, idx) AS first_difficulty FROM proc WHERE error IS NULL GROUP BY split""",
        ),
        "manifest": sql(
            (*PREP, REPORT),
            f"""SELECT 'v1' AS pipeline_contract_version, 'v1' AS reward_contract_version,
              '{",".join(PUBLIC_FIELDS)}' AS public_fields, '{SYSTEM}' AS system_prompt, split, record_count,
              failed_count, duplicate_prompt_count,
              (SELECT count(*) FROM proc p WHERE p.split = rep.split AND error_code = 'no_marker') AS no_marker,
              (SELECT count(*) FROM proc p WHERE p.split = rep.split AND error_code = 'unparseable_answer')
                AS unparseable
            FROM rep""",
        ),
        "jsonl_roundtrip": _records(extra=", reference_solution"),
        "parquet_roundtrip": _records(),
        "report_roundtrip": sql(
            EVALUATE,
            f"""SELECT 'given' AS model_name, 'test' AS split, (SELECT count(*) FROM feat) AS num_samples,
              (SELECT {r6('avg(exact_)')} FROM feat) AS exact_match_accuracy,
              (SELECT {r6('avg(reward)')} FROM feat) AS mean_composite_reward,
              (SELECT {r6('avg(format_)')} FROM feat) AS mean_format_reward, difficulty, {_METRICS}
            FROM labelled GROUP BY difficulty""",
        ),
        "evaluate_run": sql(
            (
                *PREP,
                *SCORE,
                """chosen AS (SELECT f.*, coalesce(p.difficulty, 'unknown') AS difficulty
    FROM feat f JOIN proc p ON p.src_id = f.prompt_id WHERE p.split = 'test')""",
            ),
            f"""SELECT 'given' AS model_name, 'test' AS split, (SELECT count(*) FROM chosen) AS num_samples,
              (SELECT {r6('avg(exact_)')} FROM chosen) AS exact_match_accuracy,
              (SELECT {r6('avg(reward)')} FROM chosen) AS mean_composite_reward,
              (SELECT {r6('avg(format_)')} FROM chosen) AS mean_format_reward, difficulty, {_METRICS}
            FROM chosen GROUP BY difficulty""",
        ),
        "load_trainer_split": sql(PREP, _RL_VIEW + " AND split = 'test'"),
        "build_dataset": _records(),
        "build_no_difficulty": sql(
            PREP,
            f"""SELECT {RECORD.removesuffix(", difficulty")}, count(*) OVER (PARTITION BY split) AS split_rows
            FROM proc WHERE error IS NULL""",
        ),
        "stream_scores": _REWARD,
        "stream_eval": _BY_DIFFICULTY,
        "stream_advantages": _ADVANTAGES,
        "stream_advantages_uneven": sql(
            (
                *SCORE,
                """member AS (
    SELECT prompt_id, gen_idx, reward FROM feat WHERE gen_idx < 1 + prompt_id % 6
    UNION ALL
    SELECT prompt_id, gen_idx + 4, reward FROM feat WHERE gen_idx < 2 AND gen_idx + 4 < 1 + prompt_id % 6)""",
            ),
            f"""SELECT prompt_id, gen_idx, {r6('''(reward - avg(reward) OVER w)
              / (stddev_pop(reward) OVER w + 1e-8)''')} AS advantage
            FROM member WINDOW w AS (PARTITION BY prompt_id)""",
        ),
    }
