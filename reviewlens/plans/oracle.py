"""DuckDB oracle SQL for every SQL-expressible query in the catalogue.

Views ``documents``, ``labels``, ``pages``, ``events`` ... are registered by
the checker.  Each statement rebuilds the FIXTURES views inline.
"""

from __future__ import annotations

from reviewlens.operators.eda import english_stop_words
from reviewlens.plans import sqltext as S
from reviewlens.functions import text as X

V1 = """(select doc_id,
  case when doc_id % 23 = 0 then NULL when doc_id % 29 = 0 then '   ' else text end as review_text,
  case doc_id % 8 when 0 then NULL when 6 then 4.5::DOUBLE when 7 then 0.0::DOUBLE
       else cast(doc_id % 8 as DOUBLE) end as rating,
  lang, source from documents)"""

CLEANED = f"""(select doc_id, review_text, rating, lang, source,
  {S.clean_text('review_text')} as clean_text, {S.sentiment('rating')} as sentiment
  from {V1} where review_text is not null)"""

WORK = f"""(select doc_id, clean_text, sentiment, rating, length(clean_text) as char_len,
  len({S.ws_tokens('clean_text')}) as word_len from {CLEANED} c where {S.non_blank('clean_text')})"""

V2 = """(select d.doc_id, d.text, d.lang,
  cast(case when l.toxic = 1 then 0 when l.quality = 0 then 1 else 2 end as integer) as y
  from documents d join labels l on d.doc_id = l.doc_id)"""

_R = [f"({S.shared_value(k)} + case when y = {i} then 0.5 else 0.0 end)" for i, k in enumerate("abc")]
V3 = f"""(select doc_id, y_true,
  cast(case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as integer) as y_pred,
  p0, p1, p2, text, lang
  from (select doc_id, y_true, text, lang, r0 / (r0 + r1 + r2) as p0, r1 / (r0 + r1 + r2) as p1,
               r2 / (r0 + r1 + r2) as p2
        from (select doc_id, y as y_true, text, lang, {_R[0]} as r0, {_R[1]} as r1, {_R[2]} as r2 from {V2})))"""

V4 = """(select e.event_id, e.value as y_true, m.y_pred
  from events e join (select event_type, avg(value) as y_pred from events group by event_type) m
  on e.event_type = m.event_type)"""


def rank_sql(key: str, seed: int = 42, partition: str | None = None) -> str:
    part = f"partition by {partition} " if partition else ""
    return f"row_number() over ({part}order by md5('{seed}:' || {key}), {key})"


STOP_VALUES = ", ".join(f"({S.lit(w)})" for w in english_stop_words())

SQL: dict[str, str] = {}

# ---------------------------------------------------------------------------- EDA core
SQL["top_ngrams_by_class"] = f"""
with w as {WORK},
k as (select sentiment, {S.word_tokens('clean_text')} as toks from w where sentiment is not null),
t1 as (select sentiment, unnest(toks) as ngram, 1 as n from k),
t2 as (select sentiment, unnest({S.ngrams('toks', 2)}) as ngram, 2 as n from k),
c as (select sentiment, n, ngram, count(*) as cnt from (select * from t1 union all select * from t2) group by all),
r as (select *, row_number() over (partition by sentiment, n order by cnt desc, ngram) as rnk from c)
select sentiment, n, cast(rnk as integer) as rnk, ngram, cnt from r where rnk <= 5"""

SQL["inspect_nulls"] = f"""
with v as {V1}
select column_name, dtype, null_count, case when n_rows > 0 then round(null_count * 100.0 / n_rows, 2) end as null_pct,
       n_rows from (
  select 'doc_id' as column_name, 'bigint' as dtype, count(*) filter (where doc_id is null) as null_count,
         count(*) as n_rows from v
  union all select 'review_text', 'string', count(*) filter (where review_text is null), count(*) from v
  union all select 'rating', 'double', count(*) filter (where rating is null), count(*) from v
  union all select 'lang', 'string', count(*) filter (where lang is null), count(*) from v
  union all select 'source', 'string', count(*) filter (where source is null), count(*) from v)"""

SQL["preview_rows"] = f"""
select doc_id, substr(review_text, 1, 200) as text_200, rating from {V1} order by doc_id limit 10"""

SQL["sample_exact"] = f"""
select doc_id, rating, substr(review_text, 1, 200) as text_200 from {V1}
order by md5('42:' || doc_id), doc_id limit 100"""

SQL["null_drop"] = f"select doc_id, review_text from {V1} where review_text is not null"
SQL["null_fill"] = f"select doc_id, coalesce(review_text, '') as review_text from {V1}"

SQL["clean_text"] = f"select doc_id, clean_text from {CLEANED}"

SQL["strip_html"] = f"select page_id, {S.normalize_ws(S.strip_html('html'))} as page_text from pages"

SQL["clean_reviews"] = f"select doc_id, rating, clean_text, sentiment from {CLEANED}"

SQL["sentiment_label"] = f"""
select doc_id, rating, {S.sentiment('rating')} as sentiment,
       {S.sentiment_code(S.sentiment('rating'), '1')} as sentiment_code from {V1}"""

SQL["sentiment_code"] = f"""
select doc_id, {S.sentiment_code('label', '1')} as code_default, {S.sentiment_code('label', None)} as code_strict
from (select doc_id, case when doc_id % 5 = 0 then 'unknown' else {S.sentiment('rating')} end as label from {V1})"""

SQL["label_defaults"] = f"""
select doc_id, 'unknown' as sentiment, cast(NULL as DOUBLE) as rating, cast(rating as FLOAT) as rating_f
from {V1}"""

SQL["text_lengths"] = f"select doc_id, char_len, word_len from {WORK}"

SQL["eda_work"] = f"""select count(*) as n_docs, sum(char_len)::BIGINT as chars, sum(word_len)::BIGINT as words,
  count(distinct sentiment) as n_classes from {WORK}"""

SQL["class_distribution"] = f"""
select sentiment, count(*) as cnt,
  cast(case sentiment when 'negative' then 0 when 'neutral' then 1 when 'positive' then 2 else 3 end as integer)
  as class_order from {WORK} group by sentiment"""

SQL["rating_distribution"] = f"""
select rating, count(*) as cnt from {WORK} where rating is not null group by rating"""

SQL["length_summary"] = f"""
with w as {WORK}
select 'char' as kind, min(char_len)::BIGINT as min_len, max(char_len)::BIGINT as max_len,
       round(avg(char_len), 1) as mean_len, quantile_cont(char_len, 0.5) as median_len,
       greatest(quantile_cont(char_len, 0.99), 100.0) as display_cap from w
union all
select 'word', min(word_len)::BIGINT, max(word_len)::BIGINT, round(avg(word_len), 1),
       quantile_cont(word_len, 0.5), greatest(quantile_cont(word_len, 0.99), 50.0) from w"""

SQL["length_by_rating"] = f"""
select rating, avg(word_len) as mean_words, quantile_cont(word_len, 0.5) as median_words, count(*) as cnt
from {WORK} where rating is not null group by rating"""

_HIST = """
with w as {work}, b as (select min(char_len) as lo, max(char_len) as hi from w),
h as (select cast(least(case when b.hi > b.lo then floor((char_len - b.lo) / cast(b.hi - b.lo as double) * 50) + 1
                             else 1 end, 50) as integer) as bin, count(*) as cnt
      from w, b group by 1),
g as (select cast(range as integer) as bin from range(1, 51))
select g.bin, round(b.lo + (g.bin - 1) * (cast(b.hi - b.lo as double) / 50), 6) as bin_start,
       round(b.lo + g.bin * (cast(b.hi - b.lo as double) / 50), 6) as bin_end, coalesce(h.cnt, 0)::BIGINT as cnt
from g cross join b left join h on g.bin = h.bin"""
SQL["length_histogram"] = _HIST.format(work=WORK)

SQL["length_kde"] = f"""
with w as {WORK},
p as (select min(char_len) as lo, cast(max(char_len) - min(char_len) as double) / 99 as step, count(*) as n,
             stddev_samp(char_len) * pow(cast(count(*) as double), -0.2) as bw from w),
g as (select cast(range as integer) as grid from range(0, 100)),
c as (select grid, sum(exp(-0.5 * pow((lo + grid * step - char_len) / bw, 2)) / (n * bw * sqrt(2 * pi()))) as d
      from w, g, p group by grid)
select c.grid, round(p.lo + c.grid * p.step, 6) as x, round(c.d, 9) as density from c, p"""

SQL["duplicates"] = f"""
select (count(*) - count(distinct review_text) - max(case when review_text is null then 1 else 0 end))::BIGINT
       as n_duplicates, count(*) as n_rows from {V1}"""

SQL["duplicate_marks"] = f"""
select doc_id, doc_id <> min(doc_id) over (partition by review_text) as is_duplicate from {V1}"""

for _n, _name in ((1, "top_unigrams"), (2, "top_bigrams")):
    SQL[_name] = f"""
with k as (select {S.word_tokens('clean_text')} as toks from {WORK})
select ngram, count(*) as cnt from (select unnest({S.ngrams('toks', _n)}) as ngram from k)
group by ngram order by cnt desc, ngram limit 20"""

SQL["cloud_terms"] = f"""
with w as (select * from {WORK} where sentiment is not null),
t as (select sentiment, unnest({S.ws_tokens('clean_text')}) as ngram from w),
stops(ngram) as (values {STOP_VALUES}),
c as (select sentiment, ngram, count(*) as cnt from t where ngram not in (select ngram from stops) group by all),
r as (select *, row_number() over (partition by sentiment order by cnt desc, ngram) as rnk from c)
select sentiment, cast(rnk as integer) as rnk, ngram, cnt from r where rnk <= 100"""

SQL["cloud_doc_counts"] = f"""
select sentiment, count(*) as n_docs from {WORK} where sentiment is not null group by sentiment"""

SQL["vocab_stats"] = f"""
with w as {WORK}, t as (select unnest({S.ws_tokens('lower(clean_text)')}) as tok from w)
select (select count(distinct tok) from t) as vocab_size, (select count(*) from t) as total_tokens,
       (select count(*) from w) as n_docs,
       round((select count(*) from t) / (select count(*) from w), 1) as avg_tokens_per_doc"""

SQL["length_rating_corr"] = f"""
select round(corr(cast(word_len as double), rating), 6) as corr_words_rating,
       round(corr(cast(char_len as double), rating), 6) as corr_chars_rating from {WORK} where rating is not null"""

SQL["data_quality"] = f"""
select coalesce({S.sentiment('rating')}, 'unknown') as sentiment, count(*) as n_rows,
  count(*) filter (where review_text is null) as null_texts,
  count(*) filter (where review_text is not null and length({S.rr('review_text', X.WS_RUN, '')}) = 0) as blank_texts,
  count(*) filter (where coalesce(regexp_matches(review_text, {S.lit(X.CONTRACTION_PROBE)}), false)) as with_contraction,
  round(avg(length(review_text)), 4) as mean_chars
from {V1} group by 1"""

# ---------------------------------------------------------------------------- splits
SQL["split_exact"] = f"""
with v as {V2}, n as (select count(*) as n from v),
s as (select cast(round_even(n * 0.2, 0) as BIGINT) as n_test, cast(round_even(n * 0.1, 0) as BIGINT) as n_val, n from n),
r as (select doc_id, y, {rank_sql('doc_id')} as rk from v)
select doc_id, y, case when rk <= n - n_test - n_val then 'train' when rk <= n - n_test then 'val' else 'test' end
       as split from r, s"""

SQL["split_holdout"] = f"""
with v as {V2}, s as (select count(*) as n, cast(round_even(count(*) * 0.1, 0) as BIGINT) as n_val from v),
r as (select doc_id, y, {rank_sql('doc_id')} as rk from v)
select doc_id, y, case when rk <= n - n_val then 'train' else 'holdout' end as split from r, s"""

SQL["split_stratified"] = f"""
with v as {V2},
r as (select doc_id, y, {rank_sql('doc_id', partition='y')} as rk, count(*) over (partition by y) as n from v)
select doc_id, y, case when rk <= round_even(n * 0.1, 0) then 'holdout' else 'train' end as split from r"""

SQL["kfold"] = f"""
with v as {V2}
select doc_id, y, cast(({rank_sql('doc_id', partition='y')} - 1) % 5 as integer) as fold from v"""

# ---------------------------------------------------------------------------- evaluation


def per_class_sql(src: str, by: str = "") -> str:
    """CTE body list: cm, pcr, pc, pm over a (by.., y_true, y_pred) source."""
    g = f"{by}, " if by else ""
    return f"""cm as (select {g}y_true, y_pred, count(*) as cnt from {src} group by all),
pcr as (select {g}y_true as cls, case when y_true = y_pred then cnt else 0 end as tp, cnt as sup, 0 as prd from cm
        union all select {g}y_pred, 0, 0, cnt from cm),
pc as (select {g}cls, sum(tp) as tp, sum(sup) as support, sum(prd) as predicted from pcr group by all),
pm as (select {g}cls, tp, support, predicted,
  case when predicted > 0 then tp / predicted else 0.0 end as precision,
  case when support > 0 then tp / support else 0.0 end as recall,
  case when support + predicted > 0 then 2.0 * tp / (support + predicted) else 0.0 end as f1 from pc)"""


def metrics_basic_sql(src: str, by: str = "", digits: int = 6) -> str:
    g = f"{by}, " if by else ""
    return f"""with {per_class_sql(src, by)}
select {g}round(sum(tp) / sum(support), {digits}) as accuracy, round(avg(f1), {digits}) as macro_f1,
  round(max(case when cls = 0 then f1 end), {digits}) as f1_class_0,
  round(max(case when cls = 1 then f1 end), {digits}) as f1_class_1,
  round(max(case when cls = 2 then f1 end), {digits}) as f1_class_2
from pm {'group by ' + by if by else ''}"""


ONE_VS_REST = f"""ex as (select 0 as cls, p0 as score, case when y_true = 0 then 1 else 0 end as pos from {V3}
  union all select 1, p1, case when y_true = 1 then 1 else 0 end from {V3}
  union all select 2, p2, case when y_true = 2 then 1 else 0 end from {V3}),
agg as (select cls, score, sum(pos) as pos, sum(1 - pos) as neg from ex group by all)"""

AUC_SQL = f"""with {ONE_VS_REST},
cum as (select cls, score, pos, neg,
  sum(neg) over (partition by cls order by score rows between unbounded preceding and current row) as neg_le from agg),
per as (select cast(cls as varchar) as cls,
  case when sum(pos) > 0 and sum(neg) > 0 then sum(pos * (neg_le - 0.5 * neg)) / (sum(pos) * sum(neg)) end as auc
  from cum group by cls)
select cls, round(auc, 6) as auc from per
union all select 'macro', round(case when count(auc) = count(*) then avg(auc) end, 6) from per"""

V5 = f"""(select lang as model, case when lang in ('en', 'fr') then 'classical' else 'deep' end as representation,
  accuracy, macro_f1, 0.0::DOUBLE as train_time, round(f1_class_0, 4) as f1_class_0, round(f1_class_1, 4) as f1_class_1,
  round(f1_class_2, 4) as f1_class_2 from ({metrics_basic_sql(V3, 'lang')}))"""

SQL["metrics_basic"] = metrics_basic_sql(V3)

SQL["metrics_full"] = f"""
with {per_class_sql(V3)}
select round(sum(tp) / sum(support), 6) as accuracy, round(avg(precision), 6) as precision_macro,
  round(avg(recall), 6) as recall_macro, round(avg(f1), 6) as f1_macro,
  (select auc from ({AUC_SQL}) where cls = 'macro') as roc_auc from pm"""

SQL["class_report"] = f"""
with {per_class_sql(V3)},
t as (select sum(support) as n, sum(tp) as tp, avg(precision) as mp, avg(recall) as mr, avg(f1) as mf,
  sum(precision * support) / sum(support) as wp, sum(recall * support) / sum(support) as wr,
  sum(f1 * support) / sum(support) as wf from pm),
r as (select case cls when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end as label,
  precision, recall, f1, support from pm
  union all select 'accuracy', tp / n, tp / n, tp / n, n from t
  union all select 'macro avg', mp, mr, mf, n from t
  union all select 'weighted avg', wp, wr, wf, n from t)
select label, round(precision, 4) as precision, round(recall, 4) as recall, round(f1, 4) as f1_score,
  cast(support as BIGINT) as support from r"""

SQL["error_count"] = f"select count(*) filter (where y_true <> y_pred) as n_errors from {V3}"

_CM = f"""cm as (select y_true, y_pred, count(*) as cnt from {V3} group by all),
cs as (select y_true as c from cm union select y_pred from cm),
full_cm as (select a.c as y_true, b.c as y_pred, coalesce(cm.cnt, 0)::BIGINT as cnt
  from cs a cross join cs b left join cm on cm.y_true = a.c and cm.y_pred = b.c)"""

SQL["confusion"] = f"with {_CM} select y_true, y_pred, cnt from full_cm"
SQL["confusion_norm"] = f"""with {_CM}
select y_true, y_pred, case when sum(cnt) over (partition by y_true) > 0
  then round(cnt / sum(cnt) over (partition by y_true), 6) end as rate from full_cm"""

SQL["roc_curve"] = f"""
with {ONE_VS_REST},
cum as (select cls, score,
  sum(pos) over (partition by cls order by score desc rows between unbounded preceding and current row) as tp,
  sum(neg) over (partition by cls order by score desc rows between unbounded preceding and current row) as fp
  from agg union all select distinct cls, 'infinity'::DOUBLE, 0, 0 from agg),
tot as (select cls, sum(pos) as P, sum(neg) as N from agg group by cls)
select cum.cls, round(score, 6) as threshold, round(case when P > 0 then tp / P end, 6) as tpr,
  round(case when N > 0 then fp / N end, 6) as fpr from cum join tot on cum.cls = tot.cls"""

SQL["roc_auc"] = AUC_SQL

SQL["error_samples"] = f"""
select doc_id, y_true as true_label, y_pred as predicted_label,
  case y_true when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end as true_class,
  case y_pred when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end as predicted_class,
  round([p0, p1, p2][y_pred + 1], 6) as confidence, round([p0, p1, p2][y_true + 1], 6) as true_class_prob,
  substr(text, 1, 200) as text
from {V3} where y_true <> y_pred order by md5('42:' || doc_id), doc_id limit 100"""

SQL["error_stats"] = f"""
select y_true as label, case y_true when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end as class_name,
  count(*) as total, count(*) filter (where y_true <> y_pred) as errors,
  round(count(*) filter (where y_true <> y_pred) / count(*), 6) as error_rate,
  round(1 - count(*) filter (where y_true <> y_pred) / count(*), 6) as accuracy
from {V3} group by y_true"""

SQL["regression_metrics"] = f"""
select round(avg((y_true - y_pred) * (y_true - y_pred)), 6) as mse,
  round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) as rmse, round(avg(abs(y_true - y_pred)), 6) as mae,
  round(1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)), 6) as r2 from {V4}"""

SQL["pred_vs_actual"] = f"""
with v as {V4}, b as (select least(min(y_true), min(y_pred)) as lo, greatest(max(y_true), max(y_pred)) as hi from v)
select cast(least(floor((y_true - lo) / (hi - lo) * 20), 19) as integer) as bin_true,
  cast(least(floor((y_pred - lo) / (hi - lo) * 20), 19) as integer) as bin_pred, count(*) as cnt
from v, b group by all"""

SQL["results_table"] = f"""select model, representation, accuracy, macro_f1, f1_class_0, f1_class_1, f1_class_2
from {V5}"""

SQL["comparison"] = f"""
select case when representation = 'classical' then 'Classical ML' else 'Deep Learning' end as model_type,
  coalesce(model, 'Unknown') as model, coalesce(representation, 'Unknown') as representation,
  coalesce(accuracy, 0.0) as accuracy, coalesce(macro_f1, 0.0) as macro_f1, coalesce(train_time, 0.0) as train_time
from {V5} order by macro_f1 desc, model"""

SQL["best_models"] = f"""select model, representation, accuracy, macro_f1 from {V5}
order by macro_f1 desc, model, representation limit 5"""

SQL["best_lift"] = f"""
with r as {V5}
select (select model from r order by macro_f1 desc, model limit 1) as best_model, max(accuracy) as best_accuracy,
  max(macro_f1) as best_macro_f1, avg(train_time) as mean_train_time,
  round(((select max(macro_f1) from r where representation = 'deep')
       - (select max(macro_f1) from r where representation = 'classical')) * 100, 4) as lift_pp from r"""

_SPLIT = """(select v.*, case when rk <= n - n_test - n_val then 'train' when rk <= n - n_test then 'val' else 'test' end
  as split from (select *, {rank} as rk from {src}) v,
  (select count(*) as n, cast(round_even(count(*) * 0.2, 0) as BIGINT) as n_test,
          cast(round_even(count(*) * 0.1, 0) as BIGINT) as n_val from {src}) s)"""

_V2SPLIT = _SPLIT.format(rank=rank_sql('doc_id'), src=f"(select doc_id, y from {V2})")
SQL["baseline_majority"] = f"""
with sp as {_V2SPLIT},
maj as (select y from sp where split = 'train' group by y order by count(*) desc, y limit 1),
test as (select y as y_true, (select y from maj) as y_pred from sp where split = 'test'),
m as ({metrics_basic_sql('test')})
select (select y from maj) as majority_class, accuracy, macro_f1 from m"""

_EVSPLIT = _SPLIT.format(rank=rank_sql('event_id'), src="(select event_id, value from events)")
SQL["baseline_mean"] = f"""
with sp as {_EVSPLIT}, mu as (select avg(value) as m from sp where split = 'train')
select round((select m from mu), 6) as train_mean,
  round(sqrt(avg((value - (select m from mu)) * (value - (select m from mu)))), 6) as rmse,
  round(avg(abs(value - (select m from mu))), 6) as mae from sp where split = 'test'"""

SQL["label_encode"] = f"""
select doc_id, label, cast(dense_rank() over (order by label) - 1 as integer) as code
from (select doc_id, case y when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end as label from {V2})"""

# ---------------------------------------------------------------------------- features
from reviewlens.operators import features as _FT  # noqa: E402

_WSPLIT = _SPLIT.format(rank=rank_sql('doc_id'), src="wk")
_VT = f"regexp_extract_all(lower(clean_text), {S.lit(_FT.MIN_TOKEN)}, 1)"


def _vectorise(ngram_hi: int) -> str:
    grams = " union all ".join(f"select doc_id, unnest({S.ngrams('toks', n)}) as term from t"
                               for n in range(1, ngram_hi + 1))
    return f"""wk as materialized (select doc_id, clean_text from {WORK}),
sp as materialized {_WSPLIT},
t as materialized (select doc_id, split, {_VT} as toks from sp),
g as ({grams}),
tf as materialized (select doc_id, term, count(*) as tf from g group by all),
fit as (select tf.* from tf join sp on tf.doc_id = sp.doc_id where sp.split = 'train'),
voc as materialized (select term, sum(tf) as freq, count(*) as df from fit group by term),
n as (select count(*) as n from sp where split = 'train')"""


SQL["bow"] = f"""with {_vectorise(1)}
select doc_id, tf.term, cast(tf as BIGINT) as tf from tf join voc on tf.term = voc.term"""

SQL["tfidf"] = f"""with {_vectorise(2)},
w as (select doc_id, tf.term, tf * (ln((n.n + 1) / (df + 1)) + 1) as w from tf join voc on tf.term = voc.term, n)
select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight from w"""

_STATS = f"""(select doc_id, length(review_text) as chars, {S.ws_tokens('review_text')} as wt,
  {S.punct_count('review_text')} as punct, {S.upper_count('review_text')} as upper_n
  from {V1} where review_text is not null)"""
_STAT_EXPR = """cast(chars as double) as char_count, cast(len(wt) as double) as word_count,
  case when len(wt) > 0 then list_sum(list_transform(wt, lambda x: length(x))) / len(wt) else 0.0 end as avg_word_len,
  cast(punct as double) as punct_count, case when chars > 0 then upper_n / chars else 0.0 end as capital_ratio"""

SQL["text_stats"] = f"""
select doc_id, round(char_count, 6) as char_count, round(word_count, 6) as word_count,
  round(avg_word_len, 6) as avg_word_len, round(punct_count, 6) as punct_count, round(capital_ratio, 6) as capital_ratio
from (select doc_id, {_STAT_EXPR} from {_STATS})"""

_ZCOLS = ["char_count", "word_count", "avg_word_len", "punct_count", "capital_ratio"]
SQL["text_stats_scaled"] = f"""
with st as (select doc_id, {_STAT_EXPR} from {_STATS}),
sp as {_SPLIT.format(rank=rank_sql('doc_id'), src='st')},
m as (select {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in _ZCOLS)} from sp where split = 'train')
select doc_id, split, {', '.join(f'round(({c} - m_{c}) / case when s_{c} = 0 then 1.0 else s_{c} end, 6) as z_{c}'
                                 for c in _ZCOLS)}
from sp, m"""

_TF = f"""tf as (select term, count(*) as freq from (select unnest({S.word_tokens('clean_text')}) as term from {WORK})
  group by term having count(*) >= 2)"""

SQL["vocab_by_freq"] = f"""with {_TF}
select term, freq, cast(row_number() over (order by freq desc, term) + 1 as integer) as id from tf"""

SQL["vocab_first_seen"] = f"""
with t as (select doc_id, {S.word_tokens('clean_text')} as toks from {WORK}),
e as (select doc_id, unnest(toks) as term, generate_subscripts(toks, 1) - 1 as pos from t),
f as (select term, count(*) as freq, min((doc_id, pos)) as fp from e group by term having count(*) >= 2)
select term, freq, fp[1] as first_doc, cast(fp[2] as integer) as first_pos,
  cast(row_number() over (order by fp[1], fp[2]) + 1 as integer) as id from f"""

SQL["encode_sequences"] = f"""
with wk as materialized (select doc_id, clean_text from {WORK}),
t as materialized (select doc_id, {S.word_tokens('clean_text')} as toks from wk),
e as materialized (select doc_id, unnest(toks) as term, generate_subscripts(toks, 1) - 1 as pos from t),
tf as (select term, count(*) as freq from e group by term having count(*) >= 2),
voc as (select term, cast(row_number() over (order by freq desc, term) + 1 as integer) as id from tf),
j as (select e.doc_id, e.pos, coalesce(voc.id, 1) as id from e left join voc on e.term = voc.term),
s as (select doc_id, cast(pos // 256 as integer) as win, string_agg(cast(id as varchar), ',' order by pos) as ids,
        cast(count(*) as integer) as n from j group by all)
select doc_id, win as window, n as length, ids || repeat(',0', 256 - n) as ids from s
union all
select doc_id, 0, 0, array_to_string(list_transform(range(256), lambda x: '0'), ',') from t where len(toks) = 0"""

SQL["token_stats"] = f"""
with {_TF}
select (select count(*) from tf) + 2 as vocab_size, count(*) as n_docs,
  round(avg(len({S.word_tokens('clean_text')})), 6) as avg_tokens_per_doc from {WORK}"""

# ---------------------------------------------------------------------------- sources
for _q in ("ingest_jsonl", "ingest_csv", "ingest_json"):
    SQL[_q] = f"select doc_id, review_text, rating, lang, source from {V1}"
SQL["stage_roundtrip"] = f"select doc_id, clean_text, sentiment from {CLEANED}"

# ---------------------------------------------------------------------------- streaming
SQL["clean_stream"] = f"select doc_id, clean_text, sentiment from {CLEANED}"
SQL["stream_event_counts"] = """
select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as cnt
from events group by all"""

# ---------------------------------------------------------------------------- lexical
SQL["lemma_text"] = f"select doc_id, array_to_string({S.word_tokens('clean_text')}, ' ') as lemma from {WORK}"
SQL["preprocess"] = SQL["token_stats"]

# ---------------------------------------------------------------------------- EDA driver
SQL["run_eda"] = f"""
with w as {WORK}
select 'class_distribution' as finding, sentiment as key, cast(count(*) as double) as value from w group by sentiment
union all select 'rating_distribution', cast(rating as varchar), cast(count(*) as double) from w
  where rating is not null group by rating
union all select 'length_summary', 'char', round(avg(char_len), 1) from w
union all select 'length_summary', 'word', round(avg(word_len), 1) from w
union all select 'duplicates', 'n_duplicates', cast(count(*) - count(distinct review_text)
  - max(case when review_text is null then 1 else 0 end) as double) from {V1}
union all select 'vocab', 'vocab_size', cast(count(distinct tok) as double)
  from (select unnest({S.ws_tokens('lower(clean_text)')}) as tok from w)
union all select 'cloud_docs', sentiment, cast(count(*) as double) from w
  where sentiment is not null group by sentiment
union all select 'length_histogram', cast(bin as varchar), cast(cnt as double) from ({SQL["length_histogram"]})
union all select 'length_density', cast(grid as varchar), density from ({SQL["length_kde"]})
union all select 'words_by_rating', cast(rating as varchar), round(mean_words, 6) from ({SQL["length_by_rating"]})
union all select 'top_1_grams', ngram, cast(cnt as double) from ({SQL["top_unigrams"]})
union all select 'top_2_grams', ngram, cast(cnt as double) from ({SQL["top_bigrams"]})
union all select 'ngrams_by_class', concat_ws(':', sentiment, n, ngram), cast(cnt as double) from ({SQL["top_ngrams_by_class"]})
union all select 'cloud_terms', concat_ws(':', sentiment, ngram), cast(cnt as double) from ({SQL["cloud_terms"]})"""

SQL["lemma_dictionary"] = f"""
with k as materialized (select doc_id, {S.word_tokens('clean_text')} as toks from {WORK}),
t as materialized (select doc_id, unnest(toks) as term, unnest(range(len(toks))) as pos from k),
d as materialized (select distinct term from t),
m as (select a.term, coalesce(b.term, a.term) as w from d a
      left join d b on a.term like '%s' and b.term = left(a.term, len(a.term) - 1)),
j as (select doc_id, string_agg(w, ' ' order by pos) as txt from t join m using (term) group by doc_id)
select k.doc_id, coalesce(txt, '') as processed_text from k left join j using (doc_id)"""

# ---------------------------------------------------------------------------- learners with a closed form
# The learn split: labelled documents, cleaned; TF-IDF of 1- and 2-grams fitted on train.
_LEARN_SPLIT = _SPLIT.format(rank=rank_sql('doc_id'), src="wk")
_NB = f"""wk as materialized (select doc_id, y, {S.clean_text('text')} as clean_text from {V2}),
sp as materialized {_LEARN_SPLIT},
t as materialized (select doc_id, split, {_VT} as toks from sp),
g as (select doc_id, unnest({S.ngrams('toks', 1)}) as term from t union all
      select doc_id, unnest({S.ngrams('toks', 2)}) as term from t),
tf as materialized (select doc_id, term, count(*) as tf from g group by all),
voc as materialized (select term, count(*) as df from tf join sp using (doc_id) where split = 'train' group by term),
n as (select count(*) as n from sp where split = 'train'),
w as (select doc_id, tf.term, tf * (ln((n.n + 1) / (df + 1)) + 1) as w from tf join voc on tf.term = voc.term, n),
x as materialized (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as v from w),
nt as (select count(*) as n_terms from voc)"""


def _nb_fit(name: str, fit: str, alpha: str = "1.0") -> str:
    """CTEs: ``<name>`` with doc_id, y_true, y_pred of the test split, fitted on the rows of sp where ``fit`` holds."""
    return f"""{name}_c as (select distinct y from sp where {fit}),
{name}_f as materialized (select term, y, sum(v) as f from x join sp using (doc_id) where {fit} group by all),
{name}_s as materialized (select term, sum(f) as s from {name}_f group by term),
{name}_d as (select c.y, ln({alpha} * n_terms + (select sum(s) from {name}_s)
    - coalesce((select sum(f) from {name}_f where y = c.y), 0)) as d from {name}_c c, nt),
{name}_x as (select doc_id, term, v from x join sp using (doc_id) where split = 'test'),
{name}_p as (select doc_id, d.y as c, sum(v * (d.d - ln({alpha} + coalesce(s.s, 0) - coalesce(f.f, 0)))) as score
  from {name}_x cross join {name}_d d left join {name}_s s using (term) left join {name}_f f on f.term = {name}_x.term and f.y = d.y
  group by all),
{name}_b as (select doc_id, c from {name}_p qualify row_number() over (partition by doc_id order by score desc, c) = 1),
{name} as materialized (select sp.doc_id, sp.y as y_true, cast(coalesce(c, (select min(y) from {name}_c)) as integer) as y_pred
  from sp left join {name}_b using (doc_id) where split = 'test')"""


def _f1_of(src: str, by: str = "") -> str:
    """Accuracy and macro F1 over the union of true and predicted classes, by group."""
    k = f"{by}, " if by else ""
    g = f" group by {by}" if by else ""
    return f"""(select {k}sum(tp) / sum(sup) as accuracy, avg(case when sup + prd > 0 then 2.0 * tp / (sup + prd) else 0.0 end) as macro_f1
  from (select {k}cls, sum(tp) as tp, sum(sup) as sup, sum(prd) as prd from (
    select {k}y_true as cls, case when y_true = y_pred then 1 else 0 end as tp, 1 as sup, 0 as prd from {src}
    union all select {k}y_pred, 0, 0, 1 from {src}) group by {k}cls){g})"""


SQL["nb_predictions"] = f"""with {_NB}, {_nb_fit('p', "split = 'train'")} select * from p"""

_CURVE = f"""lr as (select *, row_number() over (order by md5('7:' || doc_id), doc_id) as lrk from sp where split = 'train')"""
SQL["learning_curve"] = f"""with {_NB}, {_CURVE}, {', '.join(_nb_fit(f'p{i}', f"doc_id in (select doc_id from lr where lrk <= round_even({f} * (select count(*) from lr), 0))") for i, f in enumerate((0.25, 0.5, 1.0)))}
{' union all '.join(f"select {f}::DOUBLE as fraction, round(accuracy, 6) as accuracy, round(macro_f1, 6) as macro_f1 from {_f1_of(f'p{i}')}" for i, f in enumerate((0.25, 0.5, 1.0)))}"""

# Folds by rank within the label; what lies outside a fold is the total less its own.
_CV = f"""kf as materialized (select doc_id, y, cast((row_number() over (partition by y order by md5('42:' || doc_id), doc_id) - 1) % 5 as integer)
  as fold from sp where split = 'train'),
ff as materialized (select term, y, fold, sum(v) as f from x join kf using (doc_id) group by all),
ft as materialized (select term, y, sum(f) as f from ff group by all),
al as (select unnest([0.1, 0.5, 1.0])::DOUBLE as alpha),
cy as (select distinct y as c from kf),
fo as (select distinct fold from kf),
oc as materialized (select fold, c, (select sum(f) from ff where ff.fold <> fo.fold and ff.y = cy.c) as f from fo, cy),
dd as (select fold, c, alpha, ln(alpha * n_terms + (select sum(f) from oc o where o.fold = oc.fold and o.c <> oc.c)) as d from oc, al, nt),
xo as materialized (select k.doc_id, k.fold, x.term, x.v, cy.c, coalesce((select 0.0), 0.0) + coalesce(ft.f, 0) - coalesce(ff.f, 0) as o
  from x join kf k using (doc_id) cross join cy left join ft on ft.term = x.term and ft.y = cy.c
  left join ff on ff.term = x.term and ff.y = cy.c and ff.fold = k.fold),
xs as materialized (select *, sum(o) over (partition by doc_id, term) - o as rest from xo),
sc as (select doc_id, fold, alpha, c, sum(v * (d - ln(alpha + greatest(rest, 0.0)))) as score from xs join dd using (fold, c) group by all),
cp as materialized (select sc.alpha, sc.fold, kf.y as y_true, sc.c as y_pred from sc join kf using (doc_id)
  qualify row_number() over (partition by doc_id, alpha order by score desc, c) = 1),
cv as materialized (select alpha, avg(macro_f1) as m, stddev_pop(macro_f1) as sd from {_f1_of('cp', 'alpha, fold')} group by alpha)"""
SQL["tune_grid"] = f"""with {_NB}, {_CV}
select alpha, round(m, 6) as mean_metric, round(sd, 6) as std_metric, cast(row_number() over (order by m desc, alpha) as integer) as rank from cv"""

SQL["tuned_delta"] = f"""with {_NB}, {_CV}, {_nb_fit('p', "split = 'train'")},
{_nb_fit('q', "split = 'train'", "(select alpha from cv order by m desc, alpha limit 1)")}
select round(a.macro_f1, 6) as default_f1, round(b.macro_f1, 6) as tuned_f1, round(round(b.macro_f1, 6) - round(a.macro_f1, 6), 6) as delta
from {_f1_of('p')} a, {_f1_of('q')} b"""

# Text statistics of the rated reviews, scaled on train; normal equations solved by Gauss-Jordan steps over a nested list.
_RATED = f"(select doc_id, rating, review_text from {V1} where rating is not null and review_text is not null)"
_ZS = f"""wk as materialized {_RATED},
sp as materialized {_SPLIT.format(rank=rank_sql('doc_id'), src='wk')},
st as materialized (select doc_id, split, rating, {_STAT_EXPR} from (select *, length(review_text) as chars, {S.ws_tokens('review_text')} as wt,
  {S.punct_count('review_text')} as punct, {S.upper_count('review_text')} as upper_n from sp)),
mo as (select {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in _ZCOLS)} from st where split = 'train'),
z as materialized (select doc_id, split, rating, [1.0, {', '.join(f'({c} - m_{c}) / case when s_{c} = 0 then 1.0 else s_{c} end' for c in _ZCOLS)}, rating] as r
  from st, mo),
gm as materialized (select list(m order by i) as m from (select i, list(s order by j) as m from (
  select i, j, sum(r[i] * r[j]) as s from z, range(1, 8) a(i), range(1, 8) b(j) where split = 'train' group by i, j) group by i))"""


def _solved(name: str, src: str, alpha: str) -> str:
    """CTE ``<name>``: the 6 coefficients from the 7 x 7 products ``src.m``."""
    a = f"case when i = j and i > 1 then {alpha} else 0.0 end"
    step = "m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]"
    return f"""{name}_j as (select 0 as k, list_transform(range(1, 8), lambda i: list_transform(range(1, 8), lambda j: m[i][j] + {a})) as m from {src}
  union all select k + 1, list_transform(range(1, 8), lambda i: list_transform(range(1, 8),
    lambda j: case when i = k + 1 then m[i][j] / m[i][i] else {step} end)) from {name}_j where k < 6),
{name} as materialized (select list_transform(range(1, 7), lambda i: m[i][7]) as b from {name}_j where k = 6)"""


SQL["linear_coefficients"] = f"""with recursive {_ZS}, {_solved('l', 'gm', '0.0')}, {_solved('d', 'gm', '1.0')}
select unnest(['intercept', {', '.join(S.lit(c) for c in _ZCOLS)}]) as feature,
  unnest(list_transform(l.b, lambda v: round(v, 6))) as linear, unnest(list_transform(d.b, lambda v: round(v, 6))) as ridge from l, d"""

_ERRORS = """select {name} as model, round(sqrt(avg(e * e)), 6) as rmse, round(avg(abs(e)), 6) as mae
  from (select rating - list_dot_product(r[1:6], b) as e from z, {src} where split = 'test')"""
_REGS = " union all ".join(_ERRORS.format(name=S.lit(n), src=s) for n, s in (("linear", "l"), ("ridge", "d")))
SQL["stats_regressions"] = f"""with recursive {_ZS}, {_solved('l', 'gm', '0.0')}, {_solved('d', 'gm', '1.0')}
select model, 'text_stats' as representation, rmse, mae from ({_REGS})"""

SQL["batch_scoring"] = f"""with recursive {_ZS}, {_solved('d', 'gm', '1.0')}
select doc_id, rating as label, round(list_dot_product(r[1:6], b), 6) as prediction from z, d where split = 'test'"""

SQL["fitted_comparison"] = f"""with a as ({SQL["nb_predictions"]}), b as ({SQL["baseline_majority"]}), c as ({SQL["stats_regressions"]})
select 'Classical ML' as model_type, 'complement_nb' as model, 'tfidf' as representation, round(accuracy, 6) as accuracy,
  round(macro_f1, 6) as macro_f1, NULL::DOUBLE as rmse, NULL::DOUBLE as mae from {_f1_of('a')}
union all select 'Baseline', 'majority', 'Unknown', accuracy, macro_f1, NULL, NULL from b
union all select 'Regression', model, representation, NULL, NULL, rmse, mae from c"""

from reviewlens.operators import learn as _ML  # noqa: E402

_DRAWN = _ML.drawn(_ML.RIDGE_RANGE, 5)  # the seeded draw is part of the query's definition
_FOLD_GRAM = f"""kz as materialized (select r, cast((row_number() over (order by md5('42:' || doc_id), doc_id) - 1) % 5 as integer) as fold
  from z where split = 'train'),
fs as materialized (select f.fold, a.alpha, i, j, sum(r[i] * r[j]) + max(case when i = j and i > 1 and i < 7 then a.alpha else 0.0 end) as s
  from kz, (select distinct fold from kz) f, (select unnest([{', '.join(map(repr, _DRAWN))}])::DOUBLE as alpha) a,
    range(1, 8) x(i), range(1, 8) y(j) where kz.fold <> f.fold group by all),
fg as materialized (select fold, alpha, list(m order by i) as m from (select fold, alpha, i, list(s order by j) as m from fs group by all) group by all),
jj as (select fold, alpha, 0 as k, m from fg
  union all select fold, alpha, k + 1, list_transform(range(1, 8), lambda i: list_transform(range(1, 8),
    lambda j: case when i = k + 1 then m[i][j] / m[i][i] else m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] end)) from jj where k < 6),
bb as (select fold, alpha, list_transform(range(1, 7), lambda i: m[i][7]) as b from jj where k = 6),
er as (select alpha, fold, sqrt(avg(pow(r[7] - list_dot_product(r[1:6], b), 2))) as e from kz join bb using (fold) group by all)"""
SQL["tune_random"] = f"""with recursive {_ZS}, {_FOLD_GRAM}
select alpha, round(avg(e), 6) as mean_metric, round(stddev_pop(e), 6) as std_metric,
  cast(row_number() over (order by avg(e), alpha) as integer) as rank from er group by alpha"""
