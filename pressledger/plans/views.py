"""The same views as ``tables.py`` in SQL, as WITH items for the oracles."""

CANDIDATES = """candidates as (
  select concat('order-', cast(o_orderkey as varchar)) as candidate_id,
         cast(date_trunc('week', o_orderdate) as date) as cycle_id,
         case when o_orderpriority in ('1-URGENT','2-HIGH') then 'Paper'
              when o_orderpriority = '5-LOW' and o_orderkey % 3 = 0 then 'Policy' else 'News' end as category,
         40 + (o_orderkey*7919 + o_custkey*31) % 61 as score, o_custkey as source_key, o_orderstatus
  from orders)"""

EVENT_LOG = """event_log as (
  select event_id as seq, ts, concat('s', cast(user_id % 20 as varchar)) as source,
         concat('k', cast((user_id*13 + event_id) % 97 as varchar)) as event_key,
         case when event_type in ('view','signup') then 'seen'
              when event_type in ('click','error') then 'pending' else 'emitted' end as status,
         event_type, user_id, value, props
  from events)"""

DOC_RECORDS = """doc_records as (
  select concat('doc-', cast(d.doc_id as varchar)) as candidate_id, d.doc_id, d.source, d.lang, d.text,
         case d.doc_id % 3 when 0 then 'Paper' when 1 then 'News' else 'Policy' end as category,
         concat(d.source, '/', d.lang, '/', cast(d.doc_id as varchar), '.md') as path, l.quality, l.toxic,
         case when l.quality is null then 'uncovered' when l.quality = 1 then 'success' else 'dropped' end as outcome
  from documents d left join labels l on d.doc_id = l.doc_id)"""

CONV_STAGES = """conv_stages as (
  select conv_id, cast(turn as integer) as pos, role as stage, text,
         case turn % 4 when 0 then 'full_text' when 1 then 'official' when 2 then 'supplement' else 'attempt' end as kind,
         concat('https://example.org/', cast(conv_id as varchar), '/', cast(turn % 3 as varchar)) as url,
         case conv_id % 3 when 0 then 'Paper' when 1 then 'News' else 'Policy' end as category
  from conversations)"""

SCORE_DIMS = """score_dims as (
  select l_orderkey, l_linenumber,
         (l_orderkey*3 + l_linenumber) % 33 as relevance, (l_orderkey*5 + l_linenumber) % 23 as novelty,
         (l_orderkey*7 + l_linenumber) % 23 as credibility, (l_orderkey*11 + l_linenumber) % 18 as impact,
         (l_orderkey*13 + l_linenumber) % 13 as team, (l_orderkey*17 + l_linenumber) % 8 as timeliness
  from lineitem)"""

SELECTION = CANDIDATES + """,
ranked as (
  select *, row_number() over (partition by cycle_id, category order by score desc, candidate_id) as group_rank
  from candidates where score >= 60),
policy as (
  select cycle_id, count(*) as n from ranked where category = 'Policy' and group_rank <= 3 group by cycle_id),
selection as (
  select r.cycle_id, r.category, r.candidate_id, r.score, r.source_key, r.group_rank,
         r.category = 'Paper' and r.group_rank <= 3 as emphasis
  from ranked r left join policy p on r.cycle_id = p.cycle_id
  where r.group_rank <= case r.category when 'Paper' then 10 when 'Policy' then 3 else 10 - coalesce(p.n, 0) end)"""
