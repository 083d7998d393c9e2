"""The registered queries as SQL, for comparison with another engine.

Queries without an entry cannot be stated this way: ROUGE-L needs a dynamic program over whole
texts, stemming a suffix-stripping procedure. Both are tested against brute force.
"""

from __future__ import annotations

from folioframe.functions import chat, markup
from folioframe.functions.text import WHITESPACE, WORD_PATTERN
from folioframe.plans.workload import HEADING, JUDGE_TEMPLATES, PROMPT, SYSTEM, WORK_MODELS
from folioframe.operators.judging import SIDES, TOP_SCORES
from folioframe.sources.schemas import MODELS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NL = "chr(10)"
BLANKS = quoted(WHITESPACE)
TOKENS = "regexp_extract_all(lower({}), " + quoted(WORD_PATTERN) + ")"
MODEL_LIST = "[" + ", ".join(quoted(m) for m in WORK_MODELS) + "]"

PAIRS = f"""pairs as (
  select d.doc_id as pair_id, d.source as model, b.text as reference_text, d.text as candidate_text
  from documents d join benchmark b on b.item_id = d.doc_id % (select count(*) from benchmark))"""

ARTICLES = f"""articles as (
  select doc_id as pos, string_split(text, {NL})[1] as title, string_split(text, {NL})[2] as abstract,
         text as content from documents)"""

ARTICLE_PAIRS = f"""{ARTICLES}, article_pairs as (
  select pos, case when pos % 7 <> 0 then title end as title, case when pos % 7 <> 0 then content end as content,
         abstract as original_abstract,
         case when pos % 4 = 1 then '<think>plan' || {NL} || {NL} || string_split(content, {NL})[3]
              else string_split(content, {NL})[3] end as generated_abstract
  from articles)"""

RESULTS = """results as (
  select unnest(case when quality = 1 then ['gemma2:2b', 'phi4-mini'] else ['gemma2:2b'] end) as model,
         doc_id as pos from labels)"""

LINE_CONVERSATIONS = f"""lines as (
  select doc_id, unnest(string_split(text, {NL})) as content,
         generate_subscripts(string_split(text, {NL}), 1) - 1 as turn from documents),
turns as (
  select doc_id as id, turn::bigint as turn,
         ['user', 'user', 'assistant', 'system', 'tool'][((turn + doc_id) % 5) + 1] as role, content from lines)"""

CONVERSATIONS = "turns as (select conv_id as id, turn, role, text as content from conversations)"

REPAIR = """marked as (
  select *, role = 'user' and coalesce(lead(role) over (partition by id order by turn), '') <> 'assistant' as orphan
  from turns),
placed as (
  select *, sum(1 + orphan::int) over (partition by id order by turn) as last from marked),
repaired as (
  select id, (last - 1 - orphan::int)::bigint as turn, role, content from placed
  union all select id, (last - 1)::bigint, 'assistant', '' from placed where orphan)"""


def replaced(source: str) -> str:
    return f"""shaped as (
  select distinct id, 0::bigint as turn, 'system' as role, {quoted(SYSTEM)} as content from {source}
  union all
  select id, row_number() over (partition by id order by turn), role, content from {source}
  where role in ('user', 'assistant'))"""


def inserted(source: str) -> str:
    return f"""starts as (
  select id, arg_min(role, turn) <> 'system' as lacking from {source} group by id),
shaped as (
  select id, 0::bigint as turn, 'system' as role, {quoted(SYSTEM)} as content from starts where lacking
  union all
  select t.id, row_number() over (partition by t.id order by turn) - 1 + lacking::int, role, content
  from {source} t join starts s on s.id = t.id)"""


def piece(template: chat.ChatTemplate) -> str:
    before, _, after = template.prefix.partition("{role}")
    header = f"case when role = 'system' then {quoted(template.system_header)} else '' end"
    body = f"trim(content, {BLANKS})" if template.trim else "content"
    return f"{quoted(before)} || role || {quoted(after)} || {header} || {body} || {quoted(template.suffix)}"


def rendered(template: chat.ChatTemplate, generation: bool) -> str:
    tail = template.generation if generation else ""
    return f"{quoted(template.bos)} || string_agg({piece(template)}, '' order by turn) || {quoted(tail)}"


def spans(template: chat.ChatTemplate) -> str:
    before, _, after = template.prefix.partition("{role}")
    lead = len(before) + len(after)
    header = f"case when role = 'system' then {len(template.system_header)} else 0 end"
    body = f"length(trim(content, {BLANKS}))" if template.trim else "length(content)"
    return f"""sized as (
  select id, turn, role, {lead} + length(role) + {header} as ahead, {body} as body from shaped),
ended as (
  select *, sum(ahead + body + {len(template.suffix)}) over (partition by id order by turn) as upto from sized),
spans as (
  select id, turn, ({len(template.bos)} + upto - {len(template.suffix)} - body)::bigint as "start",
         ({len(template.bos)} + upto - {len(template.suffix)})::bigint as "end", role = 'assistant' as is_target
  from ended)"""


def grams(tokens: str, n: int) -> str:
    words = " || ' ' || ".join(f"{tokens}[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len({tokens}) - {n - 2}), lambda i: {words})"


def f_score(hits: str, ref: str, cand: str, prefix: str) -> str:
    p, r = f"({hits} / greatest({cand}, 1))", f"({hits} / greatest({ref}, 1))"
    f = f"case when {hits} > 0 then 2 * {p} * {r} / ({p} + {r}) else 0 end"
    return f"round({p}, 6) as {prefix}_precision, round({r}, 6) as {prefix}_recall, round({f}, 6) as {prefix}_f"


def overlap(n: int, pairs: str = PAIRS, keys: str = "pair_id, model", distinct: bool = False) -> str:
    total = "max" if distinct else "sum"
    joined = " and ".join(f"o.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return f"""{pairs},
tokens as (
  select {keys}, {TOKENS.format('reference_text')} as rt, {TOKENS.format('candidate_text')} as ct from pairs),
sides as (
  select {keys}, unnest({grams('rt', n)}) as gram, 1 as r, 0 as c from tokens
  union all select {keys}, unnest({grams('ct', n)}), 0, 1 from tokens),
counts as (
  select {keys}, gram, {total}(r)::bigint as r, {total}(c)::bigint as c from sides group by all),
found as (
  select {keys}, sum(least(r, c)) as hits, sum(r) as n_ref, sum(c) as n_cand from counts group by all),
scored as (
  select {', '.join('p.' + k.strip() for k in keys.split(','))}, coalesce(hits, 0)::bigint as hits,
         coalesce(n_ref, 0)::bigint as n_ref, coalesce(n_cand, 0)::bigint as n_cand
  from pairs p left join found o on {joined})"""


def rouge_rows(n: int, keys: str = "pair_id, model", shown: str = "pair_id", pairs: str = PAIRS, prefix: str = "", distinct: bool = False) -> str:
    return f"with {overlap(n, pairs, keys, distinct)} select {shown}, {f_score('hits', 'n_ref', 'n_cand', prefix or f'rouge{n}')} from scored"


def raw_f(n: int) -> str:
    return "case when hits > 0 then 2 * (hits / n_cand) * (hits / n_ref) / (hits / n_cand + hits / n_ref) else 0 end"


def rouge_means(n: int) -> str:
    return f"""with {overlap(n)}, f as (select model, {raw_f(n)} as f from scored)
select model, null::varchar as summary, round(avg(f), 6) as average_rouge{n}_f, count(*) as n_pairs from f group by model
union all select null, 'Overall Metrics', round(avg(f), 6), count(*) from f"""


TURN_PAIRS = """pairs as (
  select a.conv_id, b.turn, a.text as reference_text, b.text as candidate_text from conversations a
  join conversations b on b.conv_id = a.conv_id and b.turn = a.turn + 1
  where a.role = 'user' and b.role = 'assistant')"""

VECTOR_PAIRS = """vectors as (
  select a.vec_id // 2 as pair_id, a.label as encoder,
         list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as similarity
  from embeddings a join embeddings b on b.vec_id = a.vec_id + 1 where a.vec_id % 2 = 0)"""

LINKS = f"""found as (
  select page_id, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'), '(?is)<a\\s[^>]*>.*?</a>') as a
  from pages),
anchors as (
  select page_id, generate_subscripts(a, 1) - 1 as pos, unnest(a) as anchor from found),
links as (
  select page_id, pos::bigint as pos,
         regexp_extract(regexp_extract(anchor, '(?is)^<a\\s[^>]*>'), '(?is)\\shref\\s*=\\s*"([^"]*)"', 1) as href,
         regexp_extract(regexp_extract(anchor, '(?is)^<a\\s[^>]*>'), '(?is)\\sclass\\s*=\\s*"([^"]*)"', 1) as class,
         regexp_replace(anchor, '(?s)<[^>]*>', '', 'g') as text
  from anchors
  union all
  select * from (values
    (-1, 0, '/x/it''s.pdf', '', 'A'), (-1, 1, '/b', 'align-middle', 'B'), (-1, 2, '/say"hi"', '', 'C'),
    (-2, 0, '/venues/acl/', '', 'V'), (-2, 1, '/volumes/v.1/', 'plain', 'Volume'), (-2, 2, '/open', '', 'open'),
    (-3, 0, '/v.1.1', 'align-middle', 'P'), (-3, 1, '/v.1.1.pdf', 'btn btn-primary', 'PDF')))"""

TITLE = f"regexp_extract(html, {quoted(markup.TITLE)}, 1)"


def file_key(name: str) -> str:
    bare = f"regexp_replace({name}, '(?i)\\.pdf$', '')"
    return f"regexp_replace(replace(lower(trim({bare}, '''\"')), ' ', '_'), '[^a-zA-Z0-9_]', '', 'g')"


def filled(template: str, **fields: str) -> str:
    """SQL expression for a template with ``{name}`` placeholders."""
    sql = quoted(template)
    for name, value in fields.items():
        sql = sql.replace("{" + name + "}", f"' || coalesce({value}, '') || '")
    return sql


PROMPT_SQL = filled(PROMPT, title="title", content="content")

ANSWERS = f"""answers as (
  select conv_id, turn, case turn % 3
    when 0 then '<think>first' || {NL} || {NL} || 'second</think>' || {NL} || {NL} || text || ' ' || chr(9)
    when 1 then '<think>' || text else text end as answer from conversations)"""

METRIC_LIST = "[" + ", ".join(quoted(m) for m in TOP_SCORES) + "]"
JUDGE = f"""judged as (
  select user_id % 100 as article, case when event_id % 2 = 0 then 'original' else 'generated' end as side,
         {METRIC_LIST}[((event_id // 2) % 4) + 1] as metric, event_id,
         case when event_type = 'error' then null else regexp_extract(props, '(\\d+)', 1)::int end as score
  from events),
attempts as (
  select *, row_number() over (partition by article, side, metric order by event_id) as attempt from judged),
accepted as (
  select article, side, metric, arg_min(score, attempt) as score from attempts
  where attempt <= 3 and score is not null group by all)"""


def record_columns() -> str:
    return ", ".join(
        f"max(case when side = '{s}' and metric = '{m}' then score end) as {s}_{m}" for s in SIDES for m in TOP_SCORES
    )


def judge_prompt_rows() -> str:
    selects = []
    for metric, template in JUDGE_TEMPLATES.items():
        for side, label in SIDES.items():
            prompt = filled(template.text, content="content", side=quoted(label), abstract=f"{side}_abstract", top=quoted(str(TOP_SCORES[metric])))
            selects.append(f"select pos, '{metric}' as metric, '{side}' as side, {TOP_SCORES[metric]} as max_score, {prompt} as prompt from article_pairs")
    return "prompts as (" + "\n union all ".join(selects) + ")"


EVALUATOR_INPUTS = f"""select pos,
  case when coalesce(title, '') <> '' then title || {NL} || {NL} else '' end || coalesce(content, '') as source,
  case when starts_with(generated_abstract, '<think>') then trim(string_split(generated_abstract, {NL} || {NL})[-1], {BLANKS})
       else generated_abstract end as system_output, original_abstract as reference
from article_pairs where (coalesce(title, '') <> '' or coalesce(content, '') <> '')
  and original_abstract is not null and generated_abstract is not null"""

NUMBERED = """n as (
  select source, doc_id, split_part(text, chr(10), 1) as title, row_number() over (partition by source order by doc_id) as pos from documents)"""


def stub_vector(text: str) -> str:
    return f"list_transform(range(16), lambda i: ('0x' || substr(md5({text}), 2 * i + 1, 2))::int::double)"


HEX = "(strpos('0123456789abcdef', {}) - 1)"


def describe(table: str, columns: list[str]) -> str:
    return "\nunion all ".join(
        f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
  round(min({c})::double, 6) as min, round(quantile_cont({c}::double, 0.25), 6) as q25,
  round(quantile_cont({c}::double, 0.5), 6) as q50, round(quantile_cont({c}::double, 0.75), 6) as q75,
  round(max({c})::double, 6) as max from {table}"""
        for c in columns
    )


SPLIT_DIGEST = "md5('3407:' || doc_id)"
SPLIT = f"case when ('0x' || substr({SPLIT_DIGEST}, 1, 8))::bigint % 1000000 < 200000 then 'validation' else 'train' end"

SQL = {
    "rouge1_pairs": rouge_rows(1),
    "rouge2_pairs": rouge_rows(2),
    "rouge1_by_source": rouge_means(1),
    "rouge2_by_source": rouge_means(2),
    "rouge1_turn_pairs": rouge_rows(1, "conv_id, turn", "conv_id, turn", TURN_PAIRS),
    "rougel_turn_pairs": f"""with recursive {TURN_PAIRS}, t as (
  select conv_id, turn, coalesce({TOKENS.format('reference_text')}, []) as a, coalesce({TOKENS.format('candidate_text')}, []) as b from pairs),
l as (
  select conv_id, turn, a, b, 0 as i, list_transform(range(len(b)), lambda j: 0::bigint) as r from t
  union all
  select conv_id, turn, a, b, i + 1, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) from (
    select *, list_transform(range(1, len(b) + 1), lambda j: case when b[j] = a[i + 1] then coalesce(r[j - 1], 0) + 1 else r[j] end) as c
    from l where i < len(a))),
m as (select conv_id, turn, len(a) as n, len(b) as o, coalesce(r[len(b)], 0) as h from l where i = len(a)),
s as (select *, h / greatest(o, 1) as p, h / greatest(n, 1) as q from m)
select conv_id, turn, round(p, 6) as "rougeL_precision", round(q, 6) as "rougeL_recall",
  round(case when p + q <> 0 then 2 * p * q / (p + q) else 0 end, 6) as "rougeL_f" from s""",
    "unigram_multiset": rouge_rows(1, prefix="unigram"),
    "unigram_set": rouge_rows(1, prefix="unigram", distinct=True),
    "ngram_counts": f"""with tokens as (select {TOKENS.format('text')} as t from documents),
g as (select unnest({grams('t', 2)}) as gram from tokens) select gram, count(*) as n_uses from g group by gram""",
    "cosine_pairs": f"with {VECTOR_PAIRS} select encoder, pair_id, round(similarity, 6) as similarity from vectors",
    "cosine_by_encoder": f"with {VECTOR_PAIRS} select encoder, round(avg(similarity), 6) as average_similarity, count(*) as n_pairs from vectors group by encoder",
    "cosine_with_summary": f"""with {VECTOR_PAIRS}
select pair_id, round(similarity, 6) as similarity, null::double as average_similarity, null::varchar as summary from vectors
union all select null, null, round(avg(similarity), 6), 'Overall Metrics' from vectors""",
    "bert_score": """with t as (
  select vec_id // 20 as pair_id, vec_id % 2 as side, vec_id as tok, embedding::double[] as v from embeddings),
s as (
  select r.pair_id, r.tok as rt, c.tok as ct, list_cosine_similarity(r.v, c.v) as sim
  from t r join t c on c.pair_id = r.pair_id and r.side = 0 and c.side = 1),
p as (select pair_id, avg(best) as p from (select pair_id, ct, max(sim) as best from s group by all) group by all),
r as (select pair_id, avg(best) as r from (select pair_id, rt, max(sim) as best from s group by all) group by all)
select pair_id, round(p, 6) as bert_precision, round(r, 6) as bert_recall,
       round(case when p + r <> 0 then 2 * p * r / (p + r) else 0 end, 6) as bert_f1 from p join r using (pair_id)""",
    "model_benchmark": f"""with a as ({rouge_means(1)}), b as ({rouge_means(2)}), c as (
  with {VECTOR_PAIRS} select 'src' || (pair_id % 20) as model, round(avg(similarity), 6) as average_similarity from vectors group by 1)
select model, average_rouge1_f, average_rouge2_f, average_similarity
from (select * from a where model is not null) full join (select * from b where model is not null) using (model) full join c using (model)""",
    "normalize_title": f"""select page_id, {TITLE} as title, lower(replace(replace(replace(trim({TITLE}, {BLANKS}), ' ', '_'), ':', ''), ',', '')) as normalized from pages""",
    "normalize_file_name": f"""with n as (
  select page_id as id, '"' || {TITLE} || '".PDF' as name from pages
  union all select p_partkey, p_name || '.pdf' from part)
select id, name, {file_key('name')} as normalized from n""",
    "safe_model_name": "select p_partkey, replace(replace(p_brand || ':' || p_type || '/' || p_name, ':', '_'), '/', '_') as safe_name from part",
    "url_segment": "select page_id, nullif(split_part(url, '/', -2), '') as segment from pages",
    "page_links": f"with {LINKS} select * from links",
    "link_kinds": f"""with {LINKS}, k as (
  select 'venue' as kind, href from links where contains(href, '/venues/')
  union all select 'volume', href from links where contains(href, '/volumes/')
  union all select 'paper', href from links where contains(href, '/') and class = 'align-middle'
  union all select 'pdf', href from links where contains(href, '.pdf') and class = 'btn btn-primary'
  union all select 'internal', href from links where contains(href, '/') and href not in ('/the', '/The', '/and'))
select kind, href, count(*) as n_links from k group by all""",
    "suffix_filter": "select page_id, url from pages where suffix(url, '.html')",
    "strip_reasoning": f"""with {ANSWERS}, s as (select *, string_split(answer, {NL} || {NL})[-1] as tail from answers)
select conv_id, turn, case when starts_with(answer, '<think>') then trim(tail, {BLANKS}) else answer end as trimmed,
       case when starts_with(answer, '<think>') then tail else answer end as untrimmed from s""",
    "strip_prompt_echo": f"""with q as (select conv_id, turn, text, role || ': ' || split_part(text, {NL}, 1) as prompt from conversations),
r as (select conv_id, turn, prompt, case when turn % 2 = 0
  then '<s>[INST] ' || prompt || ' [/INST] again [/INST]  ' || text || {NL} else prompt || {NL} || text || prompt end as response from q)
select conv_id, turn, trim(case when contains(response, '[/INST]') then string_split(response, '[/INST]')[-1]
  else replace(response, prompt, '') end, {BLANKS}) as answer from r""",
    "generation_length": f"select conv_id, turn, length(trim(chr(9) || ' ' || text || ' ' || {NL}, {BLANKS})) as n_chars from conversations",
    "source_articles": f"""with {ARTICLE_PAIRS} select pos, coalesce(title, 'No Title') as title,
  case when coalesce(title, '') <> '' then title || {NL} || {NL} else '' end || coalesce(content, '') as source from article_pairs""",
    "join_sections": f"select doc_id, replace(text, {NL}, ' ') as content from documents",
    "judge_score_parse": """select event_id, case when event_id % 5 = 3 then null else regexp_extract(props, '(\\d+)', 1)::int end as score from events""",
    "prompt_table": f"with {ARTICLES} select pos, {filled(PROMPT, title='coalesce(title, ' + quoted('No Title') + ')', content='content')} as prompt from articles",
    "judge_prompts": f"with {ARTICLE_PAIRS}, {judge_prompt_rows()} select pos, metric, side, max_score, md5(prompt) as digest from prompts",
    "inference_messages": f"""with {ARTICLES}, m as (select pos, {PROMPT_SQL} as u from articles),
d as (select pos, u, md5('<s>[INST] ' || {quoted(SYSTEM)} || {NL} || {NL} || u || ' [/INST]') as digest from m)
select pos, 0::bigint as turn, 'system' as role, {quoted(SYSTEM)} as content, digest from d
union all select pos, 1, 'user', u, digest from d""",
    "eligibility": f"""with {ARTICLE_PAIRS} select case when coalesce(title, '') = '' and coalesce(content, '') = '' then 'no source article'
  when original_abstract is null then 'no original abstract' when generated_abstract is null then 'no generated abstract'
  else 'scored' end as outcome, count(*) as n_articles from article_pairs group by 1""",
    "successful_generations": f"with {ARTICLE_PAIRS} select pos, case when coalesce(generated_abstract, '') <> '' then 'kept' else 'pending' end as state from article_pairs",
    "fetch_log": "select event_id, 200 as status from events where event_type <> 'error'",
    "strict_zip": f"with {ARTICLES} select pos, title, abstract as original_abstract, 'About ' || title as generated_abstract, false as title_differs from articles",
    "truncating_zip": f"with {ARTICLES} select pos, b.text as original_abstract, title from articles join benchmark b on b.item_id = pos",
    "dense_positions": "select doc_id, row_number() over (order by source, n_chars, doc_id) - 1 as pos from documents",
    "title_join": f"""with {ARTICLES}, last as (select title, max(pos) as pos from articles group by title)
select l.pos as left_pos, l.title, r.abstract as generated_abstract from articles l join last using (title) join articles r on r.pos = last.pos""",
    "pending_documents": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "work_list": f"""with {RESULTS}, w as (select doc_id as pos, unnest({MODEL_LIST}) as model from documents)
select pos, model from w anti join results using (pos, model)""",
    "pending_by_model": f"""with {RESULTS}, m(model_id, name, display_name) as (values {', '.join(f"({i}, '{n}', '{d}')" for i, (n, d) in MODELS.items())})
select model_id, name, display_name, (select count(*) from documents) - (select count(*) from results r where r.model = m.name) as n_pending from m""",
    "first_attempts": f"with {JUDGE} select article, side, metric, score from accepted",
    "judge_records": f"with {JUDGE}, w as (select article, {record_columns()} from accepted group by article) select * from w where "
    + " and ".join(f"{s}_{m} is not null" for s in SIDES for m in TOP_SCORES),
    "judge_means": f"""with {JUDGE}, whole as (select article from accepted group by article having count(*) = 8)
select side, metric, round(avg(score), 6) as average_score, count(*) as n_articles from accepted join whole using (article) group by all""",
    "judge_resume": f"""with {JUDGE}, {ARTICLE_PAIRS}, {judge_prompt_rows()}
select pos, side, metric, md5(prompt) as digest from prompts p
where not exists (select 1 from accepted a where a.article = p.pos and a.side = p.side and a.metric = p.metric)""",
    "evaluator_inputs": f"with {ARTICLE_PAIRS} {EVALUATOR_INPUTS}",
    "dedup_first": "select doc_id, source, text from documents where doc_id in (select min(doc_id) from documents group by text)",
    "dedup_last": "select doc_id, source from documents where doc_id in (select max(doc_id) from documents group by text)",
    "dedup_report": "select count(*) as n_before, count(distinct text) as n_after, count(*) - count(distinct text) as n_removed from documents",
    "repeated_keys": "select md5(text) as digest, count(*) as n_rows from documents group by text having count(*) > 1",
    "processed_keys": f"select distinct line from (select unnest(string_split(text, {NL})) as line from documents) where line <> ''",
    "manifest_upsert": f"""select 'known_' || doc_id as normalized_name, case when toxic = 0 then quality end::int as page_count, doc_id::varchar as file_id from labels
union all select {file_key("source || ' ' || doc_id || '.PDF'")}, (n_chars // 1000)::int, doc_id::varchar from documents where doc_id not in (select doc_id from labels)""",
    "volume_progress": """select source as volume, count(*) as n_total, count(l.doc_id) as n_done, count(*) <= count(l.doc_id) as complete
from documents d left join (select distinct doc_id from labels) l on l.doc_id = d.doc_id group by source""",
    "complete_models": f"with {RESULTS} select model, pos from results where model in (select model from results group by model having count(distinct pos) = (select count(*) from labels))",
    "resume_summary": f"with {RESULTS} select model, max(pos) + 1 as next_pos, count(*) as n_done from results group by model",
    "high_water_mark": f"""with {RESULTS}, w as (select doc_id as pos, unnest({MODEL_LIST}) as model from documents)
select model, min(pos) as done_prefix from w anti join results using (pos, model) group by model""",
    "first_positions": f"with {ARTICLES} select pos, title from articles order by pos limit 25",
    "at_position": f"with {ARTICLES} select pos, title, content from articles where pos = 5",
    "profile_counts": "\nunion all ".join(f"""select '{c}' as "column", count(*) as n_rows, count({c}) as n_non_null from documents""" for c in ("doc_id", "text", "lang", "source", "n_chars")),
    "profile_documents": describe("documents", ["doc_id", "n_chars"]),
    "profile_lineitem": describe("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]),
    "runtime_eta": """with u as (select * replace (case when user_id % 10 <> 0 then user_id end as user_id), round(value * 1000000)::bigint as us from events),
s as (select *, (sum(us) over w)::bigint as done_us, row_number() over w as n_done, count(*) over (partition by user_id) as n_all
  from u window w as (partition by user_id order by event_id))
select user_id, event_id, value, n_done, round(done_us / n_done / 1000000, 6) as mean_seconds, n_all - n_done as n_left,
  ts + to_microseconds(((done_us::hugeint * (n_all - n_done)) // n_done)::bigint) as eta from s""",
    "run_time": """with u as (select *, round(value * 1000000)::bigint as us from events)
select user_id, count(*) as n_rows, round(sum(us)::bigint / 1000000, 6) as total_seconds, round(sum(us)::bigint / 1000000 / 60, 6) as total_minutes,
  min(ts) as started, max(ts) as ended from u group by user_id""",
    "page_assembly": f"""select case when conv_id % 9 <> 0 then conv_id end as conv_id, count(*) as n_pages,
  string_agg(text || {NL} || {NL}, '' order by turn + conv_id * 100) as text from conversations group by 1""",
    "sections": f"""with m as (select doc_id, string_split(regexp_replace(text, '(?m)^({HEADING})$', chr(1) || '\\1' || chr(2), 'g'), chr(1)) as p from documents),
s as (select doc_id, (generate_subscripts(p, 1) - 1)::bigint as section, unnest(p) as piece from m)
select doc_id, section, case when contains(piece, chr(2)) then split_part(piece, chr(2), 1) else '' end as heading,
  case when contains(piece, chr(2)) then split_part(piece, chr(2), -1) else piece end as body from s
union all select * from (values
  (-1, 0, '', 'x' || chr(1) || 'y' || chr(2) || 'z keep' || chr(2) || 'end'), (-2, 0, '', ''),
  (-2, 1, 'One two.', chr(10) || 'a' || chr(1) || 'b' || chr(10)), (-2, 2, 'One two.', chr(10) || chr(2) || 'c'))""",
    "article_parts": f"""with a as (select doc_id, text || {NL} || 'References' || {NL} || '[1]' as after from documents),
o as (select *, regexp_split_to_array(after, '(?m)^(?:References|{HEADING})$')[1] as own from a)
select doc_id, 'Title' as title, own as abstract, substr(after, length(own) + 1) as content from o""",
    "trigram_check": f"""with {PAIRS}, t as (
  select pair_id, {TOKENS.format('reference_text')} as rt, {TOKENS.format('candidate_text')} as ct from pairs),
g as (select pair_id, list_distinct({grams('rt', 3)}) as own, {grams('ct', 3)} as other from t),
s as (select pair_id, list_transform(list_sort(list_transform(own, lambda g: md5('check:' || g) || g))[1:100], lambda x: substr(x, 33)) as sample, other from g)
select pair_id, len(sample) as n_sampled, len(list_intersect(sample, other)) as n_found from s""",
    "trigrams_in_corpus": f"""with t as (select item_id, {TOKENS.format('text')} as tokens from benchmark),
o as (select item_id, unnest({grams('tokens', 3)}) as gram from t), own as (select distinct item_id, gram from o),
d as (select {TOKENS.format('text')} as tokens from documents), known as (select distinct unnest({grams('tokens', 3)}) as gram from d)
select item_id, count(own.gram) as n_sampled, count(known.gram) as n_found
from (select distinct item_id from benchmark) left join own using (item_id) left join known using (gram) group by item_id""",
    "trigrams_in_benchmark": f"""with t as (select doc_id, {TOKENS.format('text')} as tokens from documents),
g as (select doc_id, list_distinct({grams('tokens', 3)}) as own from t),
s as (select doc_id, unnest(list_sort(list_transform(own, lambda g: md5('check:' || g) || g))[1:100]) as ranked from g),
own as (select doc_id, substr(ranked, 33) as gram from s),
b as (select {TOKENS.format('text')} as tokens from benchmark), known as (select distinct unnest({grams('tokens', 3)}) as gram from b)
select doc_id, count(own.gram) as n_sampled, count(known.gram) as n_found
from (select distinct doc_id from documents) left join own using (doc_id) left join known using (gram) group by doc_id""",
    "fuzzy_titles": f"""with a as (select distinct {file_key('p_name')} as left_title from part),
b as (select distinct lower(p_type || '_' || split_part(p_name, ' ', -1)) as right_title from part)
select left_title, right_title, levenshtein(left_title, right_title)::int as distance from a, b where levenshtein(left_title, right_title) <= 3""",
    "chat_from_papers": f"""with {ARTICLES}
select pos, 0::bigint as turn, 'system' as role, {quoted(chat.PAPER_SYSTEM)} as content from articles
union all select pos, 1, 'user', {filled(chat.PAPER_USER, title="coalesce(title, 'Unknown Title')", content='content')} from articles
union all select pos, 2, 'assistant', coalesce(abstract, '') from articles""",
    "standardize_roles": f"with {LINE_CONVERSATIONS} select id as doc_id, turn, role, content from turns",
    "repair_array": f"with {LINE_CONVERSATIONS}, {REPAIR} select id as doc_id, turn, role, content from repaired",
    "system_replace_array": f"with {LINE_CONVERSATIONS}, {replaced('turns')} select id as doc_id, turn, role, content from shaped",
    "system_insert_array": f"with {LINE_CONVERSATIONS}, {inserted('turns')} select id as doc_id, turn, role, content from shaped",
    "training_texts": f"""with {LINE_CONVERSATIONS}, {REPAIR}, {inserted('repaired')},
texts as (select id as doc_id, {rendered(chat.QWEN_25, False)} as text from shaped group by id)
select doc_id, {SPLIT} as split, text from texts""",
    "response_spans_array": f"""with {ARTICLES}, shaped as (
  select pos as id, 0::bigint as turn, 'system' as role, {quoted(chat.PAPER_SYSTEM)} as content from articles
  union all select pos, 1, 'user', {filled(chat.PAPER_USER, title="coalesce(title, 'Unknown Title')", content='content')} from articles
  union all select pos, 2, 'assistant', coalesce(abstract, '') from articles), {spans(chat.LLAMA_31)}
select id as pos, turn, "start", "end", is_target from spans""",
    "orphan_turns": f"with {CONVERSATIONS}, {REPAIR} select id as conv_id, turn from marked where orphan",
    "repair_conversations": f"with {CONVERSATIONS}, {REPAIR} select id as conv_id, turn, role, content as text from repaired",
    "system_replace": f"with {CONVERSATIONS}, {replaced('turns')} select id as conv_id, turn, role, content as text from shaped",
    "system_insert": f"with {CONVERSATIONS}, {inserted('turns')} select id as conv_id, turn, role, content as text from shaped",
    "render_llama": f"""with {CONVERSATIONS}, {REPAIR}, {replaced('repaired')}
select id as conv_id, count(*) as n_turns, {rendered(chat.LLAMA_31, False)} as text from shaped group by id""",
    "render_chatml": f"""with {CONVERSATIONS}, {REPAIR}, {inserted('repaired')}
select id as conv_id, count(*) as n_turns, {rendered(chat.QWEN_25, True)} as text from shaped group by id""",
    "response_spans": f"""with {CONVERSATIONS}, {inserted('turns')}, {spans(chat.QWEN_25)} select id as conv_id, turn, "start", "end", is_target from spans""",
    "training_turns": f"""with {CONVERSATIONS}, {REPAIR}, {replaced('repaired')}
select id as conv_id, turn, role, case when turn = 0 then {quoted(chat.LLAMA_31.bos)} else '' end || {piece(chat.LLAMA_31)} as piece from shaped""",
    "split_hash": f"select doc_id, {SPLIT} as split from documents",
    "split_exact": f"""select doc_id, case when row_number() over (order by {SPLIT_DIGEST}, doc_id) <= ceil(0.2 * (select count(*) from documents))
  then 'validation' else 'train' end as split from documents""",
    "budget_truncate": """with t as (select doc_id, text, regexp_extract_all(text, '[^ \\t\\r\\n]+') as t,
  list_concat(case when regexp_matches(text, '^[ \\t\\r\\n]') then [] else [''] end, regexp_extract_all(text, '[ \\t\\r\\n]+')) as g from documents)
select doc_id, len(t) as n_tokens, len(t) > 2048 as over_budget, md5(case when len(t) > 2048
  then array_to_string(list_transform(range(1, 2049), lambda i: g[i] || t[i]), '') else text end) as digest from t""",
    "budget_report": """with t as (select source, len(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as n from documents)
select source, count(*) as n_rows, sum(n)::bigint as n_tokens, max(n) as max_tokens, count(*) filter (n > 2048) as over_2048,
  count(*) filter (n > 8192) as over_8192, count(*) filter (n > 16000) as over_16000 from t group by source""",
    "generate_stub": f"""with {RESULTS}, {ARTICLES}, w as (select pos, unnest({MODEL_LIST}) as model, {PROMPT_SQL} as prompt from articles),
a as (select pos, model, md5(model || '|' || prompt) as d from w anti join results using (pos, model))
select model, pos, case when d[1] <> '0' then 'abstract ' || d end as text, case when d[1] <> '0' then 'ok' else 'failed' end as status from a""",
    "encode_stub": """select doc_id, 16::bigint as n_dims,
  list_sum(list_transform(range(16), lambda i: ('0x' || substr(md5(text), 2 * i + 1, 2))::int))::double as vector_sum from documents""",
    "judge_stub": f"""with {ARTICLE_PAIRS}, {judge_prompt_rows()},
d as (select pos, side, metric, attempt, md5(attempt || '|' || prompt) as d from prompts, (values (1), (2), (3)) t(attempt)),
s as (select pos, side, metric, arg_min(1 + {HEX.format('d[2]')} % 3, attempt) as score from d where d[1] >= '8' group by all),
whole as (select pos from s group by pos having count(*) = 8)
select side, metric, round(avg(score), 6) as average_score, count(*) as n_articles from s join whole using (pos) group by all""",
    "judge_run": f"""with {ARTICLE_PAIRS}, {judge_prompt_rows()},
d as (select pos, side, metric, attempt, md5(attempt || '|' || prompt) as d from prompts, (values (1), (2), (3)) t(attempt))
select pos, side, metric, arg_min(1 + {HEX.format('d[2]')} % 3, attempt)::int as score from d where d[1] >= '8' group by all""",
    "similarity_from_texts": f"""with {PAIRS}, v as (
  select pair_id, model, {stub_vector('reference_text')} as r, {stub_vector('candidate_text')} as c,
         reference_text is not null and pair_id % 7 <> 0 as whole from pairs)
select pair_id, model, e as encoder, case when whole then round(list_cosine_similarity(r, c), 6) end as similarity
from v, (values ('a'), ('b')) t(e)""",
    "evaluator_scores": f"""with {ARTICLE_PAIRS}, i as ({EVALUATOR_INPUTS}),
s as (select unnest({METRIC_LIST}) as dimension, system_output from i)
select dimension, round(avg(('0x' || substr(md5(dimension || '|' || system_output), 1, 4))::int / 65535), 6) as average_score,
  count(*) as n_scored from s group by dimension""",
    "bert_score_all_pairs": """with t as (
  select vec_id // 20 as pair_id, vec_id % 2 as side, vec_id as tok, embedding::double[] as v from embeddings),
s as (
  select r.pair_id, r.tok as rt, c.tok as ct, list_cosine_similarity(r.v, c.v) as sim
  from t r join t c on c.pair_id = r.pair_id and r.side = 0 and c.side = 1 where r.pair_id % 3 <> 0),
p as (select pair_id, avg(best) as p from (select pair_id, ct, max(sim) as best from s group by all) group by all),
r as (select pair_id, avg(best) as r from (select pair_id, rt, max(sim) as best from s group by all) group by all),
every as (select distinct vec_id // 10 as pair_id from embeddings)
select pair_id, round(coalesce(p, 0), 6) as bert_precision, round(coalesce(r, 0), 6) as bert_recall,
       round(case when p + r <> 0 then 2 * p * r / (p + r) else 0 end, 6) as bert_f1
from every left join p using (pair_id) left join r using (pair_id)""",
    "model_table": f"""with {PAIRS}, a as ({rouge_means(1)}), b as ({rouge_means(2)}),
v as (select model, list_cosine_similarity({stub_vector('reference_text')}, {stub_vector('candidate_text')}) as s,
  ('0x' || substr(md5('coherence|' || candidate_text), 1, 4))::int / 65535 as coherence,
  ('0x' || substr(md5('fluency|' || candidate_text), 1, 4))::int / 65535 as fluency from pairs),
m as (select model, round(avg(s), 6) as average_similarity_a, round(avg(coherence), 6) as average_coherence, round(avg(fluency), 6) as average_fluency from v group by model)
select model, average_rouge1_f as average_rouge1, average_rouge2_f as average_rouge2, average_rouge1_f as average_unigram_f,
  average_similarity_a, average_coherence, average_fluency
from m join a using (model) join b using (model)""",
    "json_arrays": "select doc_id, lang, row_number() over (partition by source, doc_id // 65536 order by doc_id) - 1 as pos from documents",
    "broken_arrays": """select 'row' as kind, doc_id::varchar as name from documents where source not in ('src1', 'src2')
union all select 'file', source from (select distinct source, doc_id // 65536 from documents where source in ('src1', 'src2'))""",
    "dedup_by_file": f"""with {NUMBERED}
select 'first' as kept, * from (select distinct on (title) title, source, pos, doc_id from n order by title, source, pos)
union all select 'last', * from (select distinct on (title) title, source, pos, doc_id from n order by title, source desc, pos desc)""",
    "title_join_by_file": f"""with {NUMBERED}, r as (select distinct on (title) title, doc_id as right_id from n order by title, source desc, pos desc)
select doc_id as left_id, title, right_id from n join r using (title)""",
    "generation_run": f"""with {ARTICLES}, w as (select pos, unnest({MODEL_LIST}) as model, {PROMPT_SQL} as prompt from articles),
a as (select pos, model, md5(model || '|' || prompt) as d from w)
select model, pos, 'abstract ' || d as text from a where d[1] <> '0'""",
    "stream_convert": "select doc_id, case when lang <> 'de' then length(text) end as n_text, case when lang <> 'de' then 'stored' else 'waiting' end as state from documents",
    "stream_manifest": "select doc_id, 'known' as source from labels union all select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "json_lines": f"with {ARTICLES} select * from articles",
    "json_quarantine": """select 'good' as kind, count(*) filter (doc_id % 10 <> 0) as n from documents
union all select 'quarantined', count(*) filter (doc_id % 10 = 0) from documents""",
    "csv_files": f"with {ARTICLES} select pos, title, content from articles",
    "utf8_repair": "select doc_id, text from documents",
    "decoded_files": "select doc_id, replace(coalesce(text, ''), chr(10), ' ') as text from documents",
    "corpus_listing": "select distinct 'lang=' || lang as event, 'source=' || source as volume from documents",
    "results_by_model": "select 'm:' || source as model, 'm_' || source as model_file, doc_id as pos, md5(text) as digest from documents",
    "output_mapping": "select replace(source, 'src', 'output_') as folder, 'paper' || doc_id || '.md' as file, n_chars from documents",
    "volume_manifest": "select lang as event, source as volume, 'paper ' || doc_id || '.pdf' as file from documents",
    "chat_dataset": "select role, count(*) as n_turns from conversations group by role",
}
