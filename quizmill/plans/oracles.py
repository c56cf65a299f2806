"""DuckDB SQL with the same rows as ``queries``, over the same tables."""

from __future__ import annotations

from ..operators.prompts import SYSTEM_PROMPTS

_SYSTEM = {v: "'" + text.replace("'", "''") + "'" for v, text in SYSTEM_PROMPTS.items()}
_RAW = """
raw as (
  select p_partkey,
    substr(sha256('q' || p_partkey), 1, 16) as question_id,
    case when p_partkey % 2 = 0 then 'Entertainment: ' || p_type else p_type end as category,
    case when p_partkey % 5 = 0 then 'boolean' else 'multiple' end as type,
    case when p_size <= 16 then 'Easy' when p_size <= 33 then 'medium' else 'hard' end as difficulty,
    'Which item is number ' || p_partkey || '?' as question,
    case when p_partkey % 5 = 0 then case when p_partkey % 2 = 0 then 'True' else 'False' end
         when p_partkey % 7 = 0 then cast(1700 + p_partkey % 300 as varchar)
         when p_partkey % 11 = 0 then 'The ' || p_name else p_name || ' ' || p_brand end as correct_answer,
    case when p_partkey % 5 = 0 then [case when p_partkey % 2 = 0 then 'False' else 'True' end]
         when p_partkey % 7 = 0 then [cast(1703 + p_partkey % 300 as varchar), cast(1709 + p_partkey % 300 as varchar), cast(1712 + p_partkey % 300 as varchar)]
         else ['plain ' || p_brand, 'other ' || p_name, 'third ' || p_type] end as incorrect_answers
  from part)"""


def _norm(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^\\pL\\pN_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _bare(x: str) -> str:
    return f"trim(regexp_replace({_norm(x)}, '^(the|a|an) ', ''))"


_Q = (
    _RAW
    + f""",
q as (
  select question_id, category, case when contains(category, ':') then trim(split_part(category, ':', 1)) else 'General' end as category_group,
    case when contains(category, ':') then trim(substr(category, instr(category, ':') + 1)) else category end as category_name,
    type, lower(difficulty) as difficulty, question, correct_answer, incorrect_answers,
    list_transform(list_sort(list_transform(list_concat([correct_answer], list_filter(incorrect_answers, lambda c: c <> correct_answer)),
      lambda c: {{'h': sha256(question_id || '␟' || c), 'c': c}})), lambda s: s.c) as choices,
    {_norm('correct_answer')} as correct_answer_norm,
    regexp_matches(correct_answer, '^[\\d\\s.,%/+-]*\\d[\\d\\s.,%/+-]*$') as answer_is_numeric, p_partkey
  from raw),
qq as (select *, list_position(choices, correct_answer) - 1 as correct_answer_position, len(choices) as n_choices,
         list_transform(choices, lambda c: {_bare('c')}) as choices_norm from q)"""
)
_ALL = (
    _Q
    + """,
aa as (
  select i.*, case kind when 0 then chr(65 + cast(correct_answer_position as int)) when 1 then 'A' when 2 then correct_answer when 3 then lower(correct_answer) || '!'
      when 4 then 'The answer is B' when 5 then 'option 2' when 6 then incorrect_answers[1] when 7 then list_last(string_split(correct_answer, ' '))
      when 8 then 'yes indeed' when 9 then 'zzz' else '' end as ai_answer,
    case when kind = 11 then 'error' else 'ok' end as status, case when kind = 10 then 'maxPredictedTokensReached' else 'eosFound' end as finish_reason
  from (select substr(sha256('q' || l_partkey), 1, 16) as question_id, 'org_model-' || (l_suppkey % 4) as model_slug, 'org/model-' || (l_suppkey % 4) as model_name,
          (['p1_constrained_mcq', 'p2_open_minimal', 'p3_open_guided'])[l_linenumber % 3 + 1] as prompt_variant, (l_orderkey * 7 + l_linenumber) % 12 as kind,
          round(l_quantity / 10, 4) as response_time, cast(floor(l_extendedprice / 1000) as bigint) as completion_tokens, strftime(l_shipdate, '%Y-%m-%d') as answered_at,
          'host-' || (l_suppkey % 2) as host, 'cpu' as hardware, 'run-' || (l_suppkey % 8) as run_id, l_orderkey * 8 + l_linenumber as seq, l_linenumber = 1 as is_warmup from lineitem) i
  join qq using (question_id))"""
)
_A = (
    _ALL
    + """,
a as (select * from aa qualify row_number() over (partition by question_id, model_slug, prompt_variant order by status = 'ok' desc, answered_at desc, seq desc) = 1)"""
)
_ACC = """round(avg(ai_correct_strict::int), 6) as accuracy_strict, round(avg(ai_correct::int), 6) as accuracy_permissive,
  round(avg(ai_correct::int) filter (where not is_empty_answer), 6) as accuracy_permissive_excl_empty"""
_MODE = "case when prompt_variant = 'p1_constrained_mcq' then 'constrained' else 'open' end"
_RESPONSES = (
    _RAW
    + """,
b as (select *, p_partkey // 50 as batch from raw),
ok as (select *, 'b' || lpad(cast(batch as varchar), 6, '0') as batch_id, cast(row_number() over (partition by batch order by p_partkey) - 1 as int) as pos from b where batch % 7 <> 6)"""
)


def _id(question: str, answer: str) -> str:
    plain = lambda x: f"regexp_replace(lower(trim({x})), '\\s+', ' ', 'g')"
    return f"substr(sha256({plain(question)} || '␟' || {plain(answer)}), 1, 16)"


def _with(ctes: str, select: str) -> str:
    return f"with {ctes.strip()} {select}"


_INCORRECT_JSON = "'[' || array_to_string(list_transform(incorrect_answers, lambda x: '\"' || x || '\"'), ',') || ']'"
_BY_LETTER = "regexp_extract(lower(ai_answer), '^(?:(?:the\\s+)?(?:answer|option|choice|number|réponse)\\s*(?:is\\s*)?[:.\\-]?\\s*)?\\(?([a-z])\\)?[.):]?$', 1)"
_BY_RANK = "regexp_extract(lower(ai_answer), '^(?:(?:the\\s+)?(?:answer|option|choice|number|réponse)\\s*(?:is\\s*)?[:.\\-]?\\s*)?\\(?(\\d{1,2})\\)?[.):]?$', 1)"
_NAMED = f"case when length(ai_answer) > 32 then null when {_BY_LETTER} <> '' then choices[ascii({_BY_LETTER}) - 96] when {_BY_RANK} <> '' then choices[nullif(cast({_BY_RANK} as int), 0)] end"
_GUARDED = f"case when not (answer_is_numeric and regexp_matches(ai_answer, '\\d')) then {_NAMED} end"


def _truth(norm: str) -> str:
    yes, no = "('true','yes','y','t','1','vrai','oui')", "('false','no','n','f','0','faux','non')"
    first = f"split_part({norm}, ' ', 1)"
    return f"case when {norm} in {yes} then true when {norm} in {no} then false when {first} in {yes} then true when {first} in {no} then false end"


_SINGLE = "case when len(list_filter(choices_norm, lambda c: c = n)) = 1 then choices[list_position(choices_norm, n)] end"
_AQ = _A + f", aq as (select a.*, choices, choices_norm, correct_answer_norm, answer_is_numeric, type, case when status = 'ok' then {_bare('ai_answer')} else '' end as n from a join qq using (question_id))"
_STAGES = f""",
j1 as (select *, {_truth('n')} as truth, {_truth('correct_answer_norm')} as want, {_GUARDED} as named, {_SINGLE} as single,
         n <> '' and len(list_filter(string_split(n, ' '), lambda w: not list_contains(string_split(correct_answer_norm, ' '), w))) = 0 as subset from aq),
j2 as (select *, case when status <> 'ok' then 'error' when n = '' then 'no_match' when type = 'boolean' and truth is not null and want is not null then 'boolean' when n = correct_answer_norm then 'exact'
         when named is not null then 'choice_letter' when single is not null then 'choice_match' when subset and not answer_is_numeric then 'fuzzy' else 'undecided' end as match_method from j1),
j3 as (select *, case match_method when 'boolean' then truth = want when 'exact' then true when 'fuzzy' then true when 'choice_letter' then choices_norm[list_position(choices, named)] = correct_answer_norm
         when 'choice_match' then choices_norm[list_position(choices, single)] = correct_answer_norm when 'no_match' then false end as ai_correct from j2)"""
_CASCADE = _AQ + _STAGES
_STRICT = "case when match_method = 'error' then null when match_method in ('boolean','exact','choice_letter','choice_match') then ai_correct else false end"
_HARD = "select question_id, any_value(question) as question, any_value(category) as category, any_value(difficulty) as difficulty, any_value(question_type) as question_type, any_value(correct_answer) as correct_answer, count(*) as n_attempts, count(ai_correct) as n_judged, count(*) filter (where ai_correct) as n_correct, count(*) filter (where is_empty_answer) as n_empty, round(avg(ai_correct::int), 6) as success_rate, count(*) filter (where ai_correct) = 0 as failed_by_everyone from s group by 1"
_IMPACT = f"select model_slug, prompt_variant, {_MODE} as mode, coalesce(match_method, 'unjudged') as match_method, count(*) as n_answers, round(count(*)::double / sum(count(*)) over (partition by model_slug, prompt_variant), 6) as share, round(avg(ai_correct::int), 6) as accuracy_permissive, round(avg(ai_correct_strict::int), 6) as accuracy_strict, round(avg(fuzzy_score), 6) as fuzzy_score_avg from s group by 1, 2, 3, 4"
_BIAS = """select model_slug, n_choices, chosen_position, count(*) as n_chosen, count(*) filter (where chosen_position = correct_answer_position) as n_correct_at_position,
  round(count(*)::double / sum(count(*)) over (partition by model_slug, n_choices), 6) as chosen_share
  from (select *, case when p between 0 and n_choices - 1 then p end as chosen_position from (select *, case when regexp_full_match(coalesce(ai_answer_norm, ''), '[a-z]') then ascii(ai_answer_norm) - 97
    when list_position(choices, ai_answer) is not null then list_position(choices, ai_answer) - 1 end as p from s where prompt_variant = 'p1_constrained_mcq')) group by 1, 2, 3"""
_PERF = f"""select model_slug, model_name, count(*) as n_total, count(*) filter (where is_scorable) as n_scorable, count(*) filter (where not is_scorable) as n_errors,
  count(*) filter (where is_scorable and ai_correct is not null) as n_judged, count(*) filter (where is_scorable and is_empty_answer) as n_empty, count(*) filter (where is_scorable and is_truncated) as n_truncated,
  round(avg(ai_correct_strict::int) filter (where is_scorable), 6) as accuracy_strict, round(avg(ai_correct::int) filter (where is_scorable), 6) as accuracy_permissive,
  round(avg(ai_correct::int) filter (where is_scorable and not is_empty_answer), 6) as accuracy_permissive_excl_empty,
  round(median(response_time) filter (where is_scorable and not is_warmup), 6) as response_time_median, round(quantile_cont(response_time, 0.95) filter (where is_scorable and not is_warmup), 6) as response_time_p95,
  round(avg(completion_tokens) filter (where is_scorable), 6) as completion_tokens_avg from r group by 1, 2"""
_LATENCY = """select model_slug, host, hardware, prompt_variant, count(*) as n_questions, round(avg(response_time), 6) as response_time_avg, round(median(response_time), 6) as response_time_median,
  round(quantile_cont(response_time, 0.95), 6) as response_time_p95, round(sum(completion_tokens) / nullif(sum(response_time), 0), 6) as tokens_per_second from s where not is_warmup group by 1, 2, 3, 4"""
_ERRORS = "select model_slug, prompt_variant, host, run_id, count(*) as n_errors, min(answered_at) as first_error_at, max(answered_at) as last_error_at from r where not is_scorable group by 1, 2, 3, 4"
_PROMPT = f"""select model_slug, prompt_variant, {_MODE} as mode, count(*) as n_questions, count(*) filter (where is_empty_answer) as n_empty, count(*) filter (where is_truncated) as n_truncated, {_ACC},
  round(avg(length(ai_answer)), 6) as answer_len_avg, round(avg(completion_tokens), 6) as completion_tokens_avg, round(median(response_time) filter (where not is_warmup), 6) as response_time_median from s group by 1, 2, 3"""
_ASKED = "'Question: ' || question"
_ABOUT = "'Category: ' || category || chr(10) || 'Difficulty: ' || difficulty || chr(10) || 'Question: ' || question || chr(10)"
_SAID = """said as (select conv_id, turn, case when turn % 4 = 1 then '<think>so' || chr(10) || 'so</think>' || chr(10) else '' end || 'Answer: "' || text || '."' || chr(10) || 'more' as text from conversations where role = 'assistant')"""

_EDGE = "[\"'`«»\\s]+"
#: The bare answer, step by step: what follows the thinking, its first line, without prefix, quotes and one last dot.
_CLEAN = f"""select conv_id, turn, trim(case when ends_with(d, '.') and not ends_with(d, '..') then d[:-2] else d end, ' ' || chr(9) || chr(10) || chr(13)) as ai_answer
  from (select *, regexp_replace(regexp_replace(regexp_replace(trim(string_split(trim(regexp_replace(coalesce(text, ''), '<think>.*?</think>', '', 'gis'), ' ' || chr(9) || chr(10) || chr(13)), chr(10))[1], ' ' || chr(9) || chr(13)),
    '^(answer|réponse)\\s*[:\\-]\\s*', '', 'i'), '^{_EDGE.replace("'", "''")}', ''), '{_EDGE.replace("'", "''")}$', '') as d from said)"""
#: The token-set ratio: sets of words, what they share and what is left, and the longest common
#: subsequence of the rests by bits (a text's places that hold a character, one character of the other at a time).
_SETS = f""", sets as (select question_id, model_slug, prompt_variant, list_sort(list_distinct(list_filter(string_split({_bare('ai_answer')}, ' '), lambda w: w <> ''))) as x,
    list_sort(list_distinct(list_filter(string_split(correct_answer_norm, ' '), lambda w: w <> ''))) as y from aq),
rests as (select *, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') as held, array_to_string(list_filter(x, lambda w: not list_contains(y, w)), ' ') as l, array_to_string(list_filter(y, lambda w: not list_contains(x, w)), ' ') as r from sets),
bits as (select *, (1::hugeint << length(l)) - 1 as whole, list_transform(string_split(r, ''), lambda c: coalesce(list_sum(list_transform(range(1, length(l) + 1), lambda i: case when l[i] = c then 1::hugeint << cast(i - 1 as int) else 0::hugeint end)), 0)::hugeint) as masks from rests),
common as (select *, length(l) - case when l = '' or r = '' then length(l) else bit_count(list_reduce(list_prepend(whole, masks), lambda v, m: ((v + (v & m)) | (v - (v & m))) & whole)) end as shared,
    length(held) as n, case when held = '' then 0 else 1 end as gap from bits),
sizes as (select *, n + gap + length(l) as p, n + gap + length(r) as q from common)"""
_FUZZY = _AQ + _SETS
_RATIO = "case when len(x) = 0 or len(y) = 0 then 0.0 when n > 0 and (l = '' or r = '') then 100.0 when n > 0 then greatest(200.0::double * (n + gap + shared) / (p + q), 200.0::double * n / (n + p), 200.0::double * n / (n + q)) else 200.0::double * shared / (p + q) end"
#: Judgments as the stored fact table has them: the cascade, then an arbiter; ids that begin with 0 have none yet.
_R = (
    _CASCADE
    + _SETS
    + f""",
j4 as (select question_id, model_slug, prompt_variant, n as ai_answer_norm, case when match_method = 'exact' then 100.0 when match_method in ('fuzzy', 'undecided') then score else 0.0 end::double as fuzzy_score,
    case when match_method <> 'undecided' then match_method when question_id < '4' then 'llm_judge' when question_id < 'c' then 'llm_judge_rejected' else 'llm_judge_failed' end as match_method,
    case when match_method <> 'undecided' then ai_correct else question_id < '4' end as ai_correct
  from j3 join (select question_id, model_slug, prompt_variant, {_RATIO} as score from sizes) using (question_id, model_slug, prompt_variant) where not starts_with(question_id, '0')),
v as (select *, {_STRICT} as ai_correct_strict from j4),
r as (
  select a.*, qq.category, qq.category_group, qq.category_name, qq.type as question_type, qq.difficulty, qq.question, qq.correct_answer, qq.choices, qq.n_choices, qq.correct_answer_position,
    v.match_method, v.ai_correct, v.ai_correct_strict, v.fuzzy_score, v.ai_answer_norm,
    status = 'ok' as is_scorable, status = 'ok' and trim(ai_answer) = '' as is_empty_answer, finish_reason = 'maxPredictedTokensReached' as is_truncated
  from a join qq using (question_id) left join v using (question_id, model_slug, prompt_variant))"""
)
_S = _R + ", s as (select * from r where is_scorable)"
_PROBE_ABOUT = "'Category: <category>' || chr(10) || 'Difficulty: <difficulty>' || chr(10) || 'Question: <probe>' || chr(10)"
_HASHES = f"""probes as (
  select 'p1_constrained_mcq' as prompt_variant, {_SYSTEM['p1_constrained_mcq']} as system,
    {_PROBE_ABOUT} || 'Options:' || chr(10) || 'A. <a>' || chr(10) || 'B. <b>' || chr(10) || 'Reply with the letter of the correct option.' || chr(10) || 'Answer:' as multiple,
    {_PROBE_ABOUT} || 'Options:' || chr(10) || 'A. True' || chr(10) || 'B. False' || chr(10) || 'Reply with the letter of the correct option.' || chr(10) || 'Answer:' as boolean
  union all select 'p2_open_minimal', {_SYSTEM['p2_open_minimal']}, 'Question: <probe>' || chr(10) || 'Answer:', 'Question: <probe>' || chr(10) || 'Answer True or False.' || chr(10) || 'Answer:'
  union all select 'p3_open_guided', {_SYSTEM['p3_open_guided']}, {_PROBE_ABOUT} || 'Reply with the exact answer only, no sentence, no explanation.' || chr(10) || 'Answer:', {_PROBE_ABOUT} || 'Reply with exactly one word: True or False.' || chr(10) || 'Answer:')"""
_SAID_QUESTION = "'He said: \"' || question || '\",' || chr(10) || 'and went'"

ORACLES: dict[str, str] = {
    "br_explode_decode": _with(_RESPONSES, "select batch_id, pos, type, difficulty, category, question, correct_answer, array_to_string(incorrect_answers, '|') as incorrect_answers from ok"),
    "br_question_id": _with(_RAW, f"select p_partkey, {_id('question', 'correct_answer')} as question_id from raw"),
    "br_dedupe": f"select {_id(chr(39) + 'q' + chr(39), 'cast(l_partkey as varchar)')} as question_id, strftime(l_shipdate, '%Y-%m-%d') as fetched_at, l_orderkey as batch_id, l_linenumber as pos from lineitem qualify row_number() over (partition by l_partkey order by strftime(l_shipdate, '%Y-%m-%d'), l_orderkey, l_linenumber) = 1",
    "br_new_questions": _with(_RAW, "select question_id, case when p_partkey % 3 = 0 then question else question || ' (new)' end as question from raw"),
    "br_new_questions_prefiltered": _with(_RAW, "select question_id, case when p_partkey % 20 <> 0 then question else question || ' (new)' end as question from raw"),
    "br_ingest_summary": _with(_RESPONSES, f"select count(distinct {_id('question', 'correct_answer')}) as unique_questions, 1000::bigint as expected_questions, arg_max(category, p_partkey) as last_category, case when count(distinct {_id('question', 'correct_answer')}) >= 1000 then 'complete' else 'partial' end as status from ok"),
    "br_response_audit": _with(_RESPONSES, "select batch % 24 + 9 as category_id, case when batch % 7 = 6 then 4 else 0 end as response_code, count(distinct batch) as n_batches, cast(sum(case when batch % 7 = 6 then 0 else 1 end) as bigint) as n_results from b group by 1, 2"),
    "sq_unescape": "select page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '&amp;', '&'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&apos;', ''''), '\\s+', ' ', 'g')) as title from pages",
    "sq_clean_questions": _with(_Q, "select question_id, category, category_group, category_name, type, difficulty, question, correct_answer, correct_answer_norm, answer_is_numeric, n_choices, length(question) as question_len, length(correct_answer) as answer_len, array_to_string(incorrect_answers, '|') as incorrect, '2026-01-02' as cleaned_at from qq"),
    "sq_shuffle": _with(_Q, "select question_id, array_to_string(choices, '|') as choices, correct_answer_position, n_choices from qq"),
    "sq_normalize": f"with t as (select doc_id, replace(strip_accents(lower(text)), 'ß', 'ss') as x from documents) select doc_id, {_norm('x')} as reference_norm, {_bare('x')} as answer_norm from t",
    "pr_render": _with(_Q, f"""select question_id, v as prompt_variant, case when v = 'p1_constrained_mcq' then 'constrained' else 'open' end as mode,
        case v when 'p1_constrained_mcq' then {_ABOUT} || 'Options:' || chr(10) || array_to_string(list_transform(choices, lambda c, i: chr(64 + cast(i as int)) || '. ' || c), chr(10)) || chr(10) || 'Reply with the letter of the correct option.' || chr(10) || 'Answer:'
          when 'p2_open_minimal' then {_ASKED} || case when type = 'boolean' then chr(10) || 'Answer True or False.' else '' end || chr(10) || 'Answer:'
          else {_ABOUT} || case when type = 'boolean' then 'Reply with exactly one word: True or False.' else 'Reply with the exact answer only, no sentence, no explanation.' end || chr(10) || 'Answer:' end as prompt_text,
        'org_' || category_group || '_v1' as slug
        from qq, (select unnest(['p1_constrained_mcq', 'p2_open_minimal', 'p3_open_guided']) as v)"""),
    "pr_pending": _with(_ALL, "select question_id, v as prompt_variant, 'org_model-1' as model_slug from qq, (select unnest(['p1_constrained_mcq', 'p2_open_minimal', 'p3_open_guided']) as v) where not exists (select 1 from aa where aa.question_id = qq.question_id and aa.prompt_variant = v and model_slug = 'org_model-1' and status = 'ok')"),
    "pr_done": _with(_ALL, "select distinct question_id, model_slug, prompt_variant from aa where status = 'ok'"),
    "pr_shard": _with(_Q, "select question_id, cast(shard as int) as shard, shard = 2 as is_shard_2 from (select question_id, list_reduce(list_prepend(0::bigint, list_transform(range(0, 16), lambda i: cast('0x' || substr(sha256(question_id), cast(i * 4 + 1 as bigint), 4) as bigint))), lambda s, d: (s * 65536 + d) % 7) as shard from qq)"),
    "pr_sample": _with(_Q, "select question_id, category, difficulty, type from (select *, row_number() over (partition by category, difficulty, type order by sha256(question_id || '␟3'), question_id) as turn from qq) order by turn, category, difficulty, type limit 50"),
    "an_parse": _with(_SAID, "select conv_id, turn, coalesce(text, '') as text, turn as prompt_tokens, null::bigint as completion_tokens, case when turn % 3 = 0 then 'maxPredictedTokensReached' else 'eosFound' end as finish_reason from said"),
    "an_clean": _with(_SAID, _CLEAN),
    "an_parse_texts": _with(_SAID, "select conv_id, turn, coalesce(text, '') as text, turn as prompt_tokens, null::bigint as completion_tokens, case when turn % 3 = 0 then 'maxPredictedTokensReached' else 'eosFound' end as finish_reason from said"),
    "an_clean_texts": _with(_SAID, _CLEAN),
    "an_errors": _with(_SAID, "select conv_id, turn, case when turn % 5 > 1 then coalesce(text, '') end as text, case turn % 5 when 0 then 'a completion without choices: {}' when 1 then 'a completion without choices: {\"choices\": []}' end as error from said"),
    "an_complete": _with(_RAW, "select question_id, case when not ends_with(question, '7?') then cast(length(question) as varchar) end as raw_answer, case when not ends_with(question, '7?') then 5 end as prompt_tokens, case when not ends_with(question, '7?') then 1 end as completion_tokens, case when not ends_with(question, '7?') then 'eosFound' end as finish_reason, case when ends_with(question, '7?') then 'error' else 'ok' end as status, case when ends_with(question, '7?') then 'refused' end as error, case when ends_with(question, '7?') then 3 else 1 end as attempt from raw"),
    "an_warmup": _with(_ALL, "select seq, run_id, row_number() over (partition by run_id order by answered_at, seq) = 1 as is_warmup from aa"),
    "an_latest": _with(_A, "select question_id, model_slug, prompt_variant, seq, status, answered_at, ai_answer from a"),
    "io_run_summary": _with(_ALL, "select run_id, model_name, model_slug, string_agg(distinct prompt_variant, '|' order by prompt_variant) as variants, count(*) filter (where status = 'ok') as n_ok, count(*) filter (where status <> 'ok') as n_error, max(answered_at) as finished_at, max(host) as host, max(hardware) as hardware from aa group by 1, 2, 3"),
    "sc_boolean": _with(_A, f"select question_id, model_slug, prompt_variant, {_truth(_bare('ai_answer'))} as label from a"),
    "sc_reference": _with(_AQ, f"select question_id, model_slug, prompt_variant, {_NAMED} as named, {_GUARDED} as guarded from aq"),
    "sc_fuzzy": _with(_FUZZY, f"select question_id, model_slug, prompt_variant, round({_RATIO}, 6) as score from sizes"),
    "sc_single_choice": _with(_AQ, f"select question_id, model_slug, prompt_variant, case when len(list_filter(choices_norm, lambda c: c = m)) = 1 then choices[list_position(choices_norm, m)] end as choice from (select *, {_bare('ai_answer')} as m from aq)"),
    "jd_cascade": _with(_CASCADE, f"select question_id, model_slug, prompt_variant, match_method, ai_correct, {_STRICT} as ai_correct_strict, n as ai_answer_norm, case match_method when 'exact' then 100.0 when 'fuzzy' then 100.0 when 'undecided' then null else 0.0 end::double as fuzzy_score from j3"),
    "jd_arbitrate": _with(_CASCADE, f"""select question_id, model_slug, prompt_variant, match_method, ai_correct, {_STRICT} as ai_correct_strict, 'arbiter' as judge_model, 'v1' as judgment_version, '2026-01-03' as judged_at
        from (select * replace (case when match_method <> 'undecided' then match_method when question_id < '4' then 'llm_judge' when question_id < 'c' then 'llm_judge_rejected' else 'llm_judge_failed' end as match_method,
          case when match_method <> 'undecided' then ai_correct else question_id < '4' end as ai_correct) from j3 where model_slug = 'org_model-2')"""),
    "jd_arbitrate_all": _with(_CASCADE, f"""select question_id, model_slug, prompt_variant, match_method, ai_correct, {_STRICT} as ai_correct_strict, 'arbiter' as judge_model, 'v1' as judgment_version, '2026-01-03' as judged_at
        from (select * replace (case when match_method <> 'undecided' then match_method when question_id < '4' then 'llm_judge' when question_id < 'c' then 'llm_judge_rejected' else 'llm_judge_failed' end as match_method,
          case when match_method <> 'undecided' then ai_correct else question_id < '4' end as ai_correct) from j3)"""),
    "jd_kept_verdicts": _with(_CASCADE, """select question_id, count(distinct ai_answer) filter (where model_slug = 'org_model-2') as n_first,
        count(distinct ai_answer) - count(distinct ai_answer) filter (where model_slug = 'org_model-2') as n_second, 0 as n_third from j3 where match_method = 'undecided' group by 1"""),
    "jd_doubled_verdicts": _with(_CASCADE, f"""select question_id, model_slug, prompt_variant, match_method, ai_correct, {_STRICT} as ai_correct_strict
        from (select * replace (case when match_method <> 'undecided' then match_method when question_id < '4' then 'llm_judge_rejected' when question_id < '8' then 'llm_judge' else 'llm_judge_failed' end as match_method,
          case when match_method <> 'undecided' then ai_correct else question_id >= '4' and question_id < '8' end as ai_correct) from j3)"""),
    "jd_verdicts": _with(_AQ, "select aq.question_id, model_slug, prompt_variant, 'Question: ' || question || chr(10) || 'Reference answer: ref' || chr(10) || 'Candidate answer: ' || ai_answer || chr(10) || 'Does the candidate answer mean the same as the reference answer? YES or NO.' as prompt, case when status = 'ok' and kind = 8 then 'yes' when kind = 9 then 'no' else 'failed' end as verdict from aq join qq using (question_id)"),
    "ft_results": _with(_R, "select question_id, model_slug, prompt_variant, question_type, difficulty, category_group, status, match_method, ai_correct, ai_correct_strict, round(fuzzy_score, 6) as fuzzy_score, is_scorable, is_empty_answer, is_truncated from r"),
    "ft_bucketed": _with(_R, "select question_id, model_slug, prompt_variant, question_type, difficulty, category_group, status, match_method, ai_correct, ai_correct_strict, round(fuzzy_score, 6) as fuzzy_score, is_scorable, is_empty_answer, is_truncated from r"),
    "mt_model_performance": _with(_R, _PERF),
    "mt_performance_by_category": _with(_S, f"select * exclude (m), round(acc - m, 6) as delta_to_model_average from (select model_slug, category, category_group, category_name, count(*) as n_questions, count(*) filter (where is_empty_answer) as n_empty, {_ACC}, avg(ai_correct::int) as acc from s group by 1, 2, 3, 4) join (select model_slug, avg(ai_correct::int) as m from s group by 1) using (model_slug)").replace("select * exclude (m), round", "select * exclude (m, acc), round"),
    "mt_performance_by_difficulty": _with(_S, f"select model_slug, prompt_variant, difficulty, question_type, count(*) as n_questions, count(*) filter (where is_empty_answer) as n_empty, {_ACC}, round(median(response_time) filter (where not is_warmup), 6) as response_time_median from s group by 1, 2, 3, 4"),
    "mt_prompt_performance": _with(_S, _PROMPT),
    "mt_latency": _with(_S, _LATENCY),
    "mt_latency_ranged": _with(_S, _LATENCY),
    "mt_model_performance_ranged": _with(_R, _PERF),
    "mt_question_hardness": _with(_S, _HARD),
    "mt_matching_impact": _with(_S, _IMPACT),
    "mt_position_bias": _with(_S, _BIAS),
    "mt_errors": _with(_R, _ERRORS),
    "rv_accuracy_long": _with(_R, f"select model_slug, model_name, measure, accuracy from (unpivot (select model_slug, model_name, accuracy_strict, accuracy_permissive, accuracy_permissive_excl_empty from ({_PERF})) on accuracy_strict, accuracy_permissive, accuracy_permissive_excl_empty into name measure value accuracy)"),
    "rv_explore_categories": _with(_S + f", hard as ({_HARD})", "select question_id, category, n_attempts, success_rate from hard where category in (select category from hard group by 1 order by count(*) desc, category limit 2)"),
    "rv_explore_questions": _with(_S, f"select question_id, category, n_attempts, success_rate from ({_HARD}) where failed_by_everyone order by success_rate asc nulls last, question_id limit 25"),
    "rv_category_gaps": _with(_S, "select model_slug, category, round(acc - m, 6) as delta_to_model_average from (select model_slug, category, avg(ai_correct::int) as acc from s group by 1, 2) join (select model_slug, avg(ai_correct::int) as m from s group by 1) using (model_slug)"),
    "rv_leaked_letters": _with(_S, "select model_slug, count(*) as n_answers from s where match_method = 'choice_letter' and prompt_variant <> 'p1_constrained_mcq' group by 1"),
    "rv_failed_arbitrations": _with(_S, "select model_slug, count(*) as n_answers from s where match_method = 'llm_judge_failed' group by 1"),
    "rv_position_labels": _with(_S, f"select model_slug, n_choices, coalesce(cast(chosen_position as varchar), 'unresolved') as position_label, n_chosen from ({_BIAS})"),
    "rv_unresolved_positions": _with(_S, f"select cast(coalesce(sum(n_chosen), 0) as bigint) as n_unresolved from ({_BIAS}) where chosen_position is null"),
    "rv_reliability": _with(_R, "select count(*) filter (where is_scorable and is_empty_answer) as n_empty, count(*) filter (where is_scorable and is_truncated) as n_truncated, count(*) filter (where not is_scorable) as n_transport_errors from r"),
    "rv_latency_for_host": _with(_S, f"select * from ({_LATENCY}) where host = 'host-1'"),
    "rv_hosts": _with(_S, "select distinct host from s where not is_warmup"),
    "rv_prompt_gaps": _with(_S, "select model_slug, round(max(p) filter (where prompt_variant = 'p1_constrained_mcq') - max(p) filter (where prompt_variant = 'p3_open_guided'), 6) as p1_minus_p3, round(max(p) filter (where prompt_variant = 'p2_open_minimal') - max(p) filter (where prompt_variant = 'p3_open_guided'), 6) as p2_minus_p3, round(avg(p) - avg(t), 6) as permissive_minus_strict from (select model_slug, prompt_variant, avg(ai_correct::int) as p, avg(ai_correct_strict::int) as t from s group by 1, 2) group by 1"),
    "rv_difficulty_pivot": _with(_S, "select model_slug, round(avg(ai_correct::int) filter (where difficulty = 'easy'), 6) as easy, round(avg(ai_correct::int) filter (where difficulty = 'medium'), 6) as medium, round(avg(ai_correct::int) filter (where difficulty = 'hard'), 6) as hard from s group by 1"),
    "rv_category_overall": _with(_S, "select category, count(*) as n_answers, round(avg(ai_correct::int), 6) as accuracy_permissive from s group by 1"),
    "qc_suite": _with(_S, """, p as (select avg(ai_correct_strict::int) as t, avg(ai_correct::int) as c from s group by model_slug, prompt_variant)
        select 'not_null' as "check", 'int_results' as "table", 'question_id' as "column", count(*) filter (where question_id is null) as n_bad from r
        union all select 'not_null', 'int_results', 'model_slug', count(*) filter (where model_slug is null) from r
        union all select 'not_null', 'int_results', 'prompt_variant', count(*) filter (where prompt_variant is null) from r
        union all select 'not_null', 'int_results', 'match_method', count(*) filter (where match_method is null) from r
        union all select 'not_null', 'int_results', 'ai_correct', count(*) filter (where ai_correct is null) from r
        union all select 'unique', 'questions', 'question_id', (select count(*) from (select 1 from qq group by question_id having count(*) > 1))
        union all select 'unique', 'int_results', 'question_id+model_slug+prompt_variant', (select count(*) from (select 1 from r group by question_id, model_slug, prompt_variant having count(*) > 1))
        union all select 'unique', 'answers', 'question_id+model_slug+prompt_variant', (select count(*) from (select 1 from aa group by question_id, model_slug, prompt_variant having count(*) > 1))
        union all select 'accepted_values', 'questions', 'difficulty', (select count(*) from qq where difficulty not in ('easy', 'medium', 'hard'))
        union all select 'accepted_values', 'questions', 'type', (select count(*) from qq where type not in ('multiple', 'boolean'))
        union all select 'accepted_values', 'int_results', 'match_method', (select count(*) from r where match_method not in ('boolean', 'exact', 'choice_letter', 'choice_match', 'fuzzy', 'no_match'))
        union all select 'relationship', 'answers', 'question_id', (select count(*) from aa where question_id not in (select question_id from qq where type = 'multiple'))
        union all select 'accepted_range', 'mart_prompt_performance', 'accuracy_strict', (select count(*) from p where t < 0 or t > 1)
        union all select 'accepted_range', 'mart_prompt_performance', 'accuracy_permissive', (select count(*) from p where c < 0 or c > 1)
        union all select 'accepted_range', 'int_results', 'fuzzy_score', (select count(*) from r where fuzzy_score < 0 or fuzzy_score > 50)
        union all select 'permissive_at_least_strict', 'mart_prompt_performance', 'accuracy_permissive', (select count(*) from p where c < t)"""),
    "qc_one_pass": _with(_S, """, p as (select avg(ai_correct_strict::int) as t, avg(ai_correct::int) as c from s group by model_slug, prompt_variant)
        select 'not_null' as "check", 'int_results' as "table", 'question_id' as "column", count(*) filter (where question_id is null) as n_bad from r
        union all select 'not_null', 'int_results', 'model_slug', count(*) filter (where model_slug is null) from r
        union all select 'not_null', 'int_results', 'prompt_variant', count(*) filter (where prompt_variant is null) from r
        union all select 'not_null', 'int_results', 'match_method', count(*) filter (where match_method is null) from r
        union all select 'not_null', 'int_results', 'ai_correct', count(*) filter (where ai_correct is null) from r
        union all select 'unique', 'questions', 'question_id', (select count(*) from (select 1 from qq group by question_id having count(*) > 1))
        union all select 'unique', 'int_results', 'question_id+model_slug+prompt_variant', (select count(*) from (select 1 from r group by question_id, model_slug, prompt_variant having count(*) > 1))
        union all select 'unique', 'answers', 'question_id+model_slug+prompt_variant', (select count(*) from (select 1 from aa group by question_id, model_slug, prompt_variant having count(*) > 1))
        union all select 'accepted_values', 'questions', 'difficulty', (select count(*) from qq where difficulty not in ('easy', 'medium', 'hard'))
        union all select 'accepted_values', 'questions', 'type', (select count(*) from qq where type not in ('multiple', 'boolean'))
        union all select 'accepted_values', 'int_results', 'match_method', (select count(*) from r where match_method not in ('boolean', 'exact', 'choice_letter', 'choice_match', 'fuzzy', 'no_match'))
        union all select 'relationship', 'answers', 'question_id', (select count(*) from aa where question_id not in (select question_id from qq where type = 'multiple'))
        union all select 'accepted_range', 'mart_prompt_performance', 'accuracy_strict', (select count(*) from p where t < 0 or t > 1)
        union all select 'accepted_range', 'mart_prompt_performance', 'accuracy_permissive', (select count(*) from p where c < 0 or c > 1)
        union all select 'accepted_range', 'int_results', 'fuzzy_score', (select count(*) from r where fuzzy_score < 0 or fuzzy_score > 50)
        union all select 'permissive_at_least_strict', 'mart_prompt_performance', 'accuracy_permissive', (select count(*) from p where c < t)"""),
    "qc_offending_keys": _with(_ALL, "select question_id, model_slug, prompt_variant, count(*) as n_rows from aa group by 1, 2, 3 having count(*) > 1 order by n_rows desc, question_id, model_slug, prompt_variant limit 20"),
    "st_bronze": _with(_RESPONSES, f"select {_id('question', 'correct_answer')} as question_id, category, type, difficulty, question, correct_answer, {_INCORRECT_JSON} as incorrect_answers, '2026-01-01' as fetched_at, batch_id from ok"),
    "pr_prompt_hash": _with(_ALL + ", " + _HASHES, "select prompt_variant, substr(sha256(system || '␟' || multiple || '␟' || boolean), 1, 12) as prompt_hash, n_answers from probes join (select prompt_variant, count(*) as n_answers from aa group by 1) using (prompt_variant)"),
    "pr_pending_all": _with(_ALL, "select question_id, v as prompt_variant, model_slug from qq, (select unnest(['p1_constrained_mcq', 'p2_open_minimal', 'p3_open_guided']) as v), (select distinct model_slug from aa) m where not exists (select 1 from aa where aa.question_id = qq.question_id and aa.prompt_variant = v and aa.model_slug = m.model_slug and status = 'ok')"),
    "pr_pending_prefiltered": _with(_ALL, "select question_id, v as prompt_variant, model_slug from qq, (select unnest(['p1_constrained_mcq', 'p2_open_minimal', 'p3_open_guided']) as v), (select distinct model_slug from aa) m where not exists (select 1 from aa where aa.question_id = qq.question_id and aa.prompt_variant = v and aa.model_slug = m.model_slug and status = 'ok')"),
    "mt_judged": _with(_CASCADE + f", js as (select * replace (case when match_method = 'undecided' then 'no_match' else match_method end as match_method, case when match_method = 'undecided' then false else ai_correct end as ai_correct) from j3 where status = 'ok'), jt as (select *, {_STRICT} as ai_correct_strict from js)", f"select model_slug, prompt_variant, {_MODE} as mode, match_method, count(*) as n_answers, round(count(*)::double / sum(count(*)) over (partition by model_slug, prompt_variant), 6) as share, round(avg(ai_correct::int), 6) as accuracy_permissive, round(avg(ai_correct_strict::int), 6) as accuracy_strict from jt group by 1, 2, 3, 4"),
    "io_responses": _with(_RESPONSES, "select 'b' || lpad(cast(batch as varchar), 6, '0') as batch_id, batch % 24 + 9 as category_id, case when batch % 7 = 6 then 4 else 0 end as response_code, case when batch % 7 = 6 then 0 else count(*) end as n_results, case when batch % 7 <> 6 then base64(encode(arg_min(question, p_partkey))) end as first_question from b group by batch"),
    "io_bronze": _with(_RAW, f"select question_id, category, type, difficulty, {_SAID_QUESTION} as question, correct_answer, {_INCORRECT_JSON} as incorrect_answers, '2026-01-01' as fetched_at, 'b0' as batch_id from raw"),
    "io_questions": _with(_Q, "select question_id, category, category_group, category_name, type, difficulty, question, correct_answer, array_to_string(incorrect_answers, '|') as incorrect_answers, array_to_string(choices, '|') as choices, correct_answer_position, n_choices, correct_answer_norm, answer_is_numeric, length(question) as question_len, length(correct_answer) as answer_len, '2026-01-02' as cleaned_at from qq"),
    "io_answers": _with(_ALL, "select question_id, model_slug, prompt_variant, model_name, seq, ai_answer, response_time, completion_tokens, finish_reason, status, is_warmup, answered_at, run_id, host, hardware from aa"),
    "io_compaction": _with(_ALL, "select model_slug, prompt_variant, count(*) as n_rows, sum(seq) as sum_seq, count(ai_answer) as n_answers, count(distinct seq % 50) as n_files_before, 1 as n_files_after from aa group by 1, 2"),
    "io_answer_files": _with(_ALL, "select question_id, model_slug, prompt_variant, seq, status, case when seq % 2 = 0 then ai_answer end as ai_answer from aa"),
    "io_judgments": _with(_R, "select question_id, model_slug, prompt_variant, match_method, ai_correct, case when model_slug = 'org_model-1' then 'v2' else 'v1' end as judgment_version from r where not starts_with(question_id, '0')"),
    "io_conform": _with(_ALL, "select model_slug, count(*) as n, 0 as n_answers, 'ai_answer string|response_time double|attempt bigint|is_warmup boolean' as types from aa where status = 'error' group by 1"),
    "io_run_manifest": _with(_ALL, "select run_id, model_slug, string_agg(distinct prompt_variant, '|' order by prompt_variant) as variants, count(*) filter (where status = 'ok') as n_ok, count(*) filter (where status <> 'ok') as n_error, max(host) as host from aa group by 1, 2"),
    "io_marts": _with(_R, "select model_slug, prompt_variant, host, run_id, count(*) as n_errors, 'prompt_performance|errors' as marts from r where not is_scorable group by 1, 2, 3, 4"),
}
