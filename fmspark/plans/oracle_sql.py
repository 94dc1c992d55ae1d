"""DuckDB oracle SQL for the registered queries.

The oracle sees only the base tables, so every statement starts with the
fixture CTEs of FIXTURES.md (built independently in SQL, one-hot expansion by
joins with the distinct category sets). Every computed column is aliased to
the name the Spark query uses, and float aggregates are rounded to 6 places
in both engines.
"""

from __future__ import annotations

FIXTURE_CTES = """
feature_rows as (
  select cast(o_orderkey as varchar) order_id, concat('SN', cast(o_orderkey as varchar)) order_sn,
    o_custkey user_id,
    cast(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) as varchar) dt,
    case when o_orderstatus='F' then 1 else 0 end target,
    (c_nationkey + cast(substr(o_orderpriority,1,1) as int)) % 2 target_planted,
    o_totalprice f_price, c_acctbal f_bal, q.qty f_qty, cast(q.nd as double) f_zero_disc,
    c_mktsegment f_seg, c_nationkey f_nation, cast(substr(o_orderpriority,1,1) as int) f_prio,
    case when o_totalprice > 250000 then 1 else 0 end f_flag
  from orders join customer on o_custkey=c_custkey
  left join (select l_orderkey, sum(l_quantity) qty,
                    sum(case when l_discount=0 then 1 else 0 end) nd
             from lineitem group by l_orderkey) q on l_orderkey=o_orderkey),
seg as (select f_seg, 5+cast(row_number() over (order by f_seg) as int) idx
        from (select distinct f_seg from feature_rows where f_seg is not null) a),
sparse_rows as (
  select order_id, target label, 1 idx, f_price/500000 val from feature_rows
  union all select order_id, target, 2, f_bal from feature_rows
  union all select order_id, target, 3, coalesce(f_qty,0e0) from feature_rows
  union all select order_id, target, 4, coalesce(f_zero_disc,0e0) from feature_rows
  union all select order_id, target, 5, cast(f_flag as double) from feature_rows
  union all select order_id, target, seg.idx, case when seg.f_seg=r.f_seg then 1e0 else 0e0 end
            from feature_rows r cross join seg
  union all select order_id, target, 11+n.f_nation, case when n.f_nation=r.f_nation then 1e0 else 0e0 end
            from feature_rows r cross join (select distinct f_nation from feature_rows where f_nation is not null) n
  union all select order_id, target, 35+p.f_prio, case when p.f_prio=r.f_prio then 1e0 else 0e0 end
            from feature_rows r cross join (select distinct f_prio from feature_rows where f_prio is not null) p),
lat as (select cast(vec_id as int) idx, cast(d - 1 as int) d, embedding[d]::double v
        from embeddings, range(1, 9) t(d)),
raw_pairs as (select order_id, label, idx, val,
                     cast(row_number() over (partition by order_id order by idx) - 1 as int) rpos
              from sparse_rows where idx <= 5),
act_pairs as (select order_id, label, idx,
                     cast(row_number() over (partition by order_id order by idx) - 1 as int) apos
              from sparse_rows where idx > 5 and val = 1),
nraw as (select order_id, cast(count(*) as int) n from raw_pairs group by order_id),
emb_vals as (select a.order_id, a.label, cast(a.apos * 8 + l.d as int) epos, l.v
             from act_pairs a join lat l on l.idx = a.idx),
split_tag as (select order_id,
  case when ('0x' || substr(md5(order_id),1,8))::bigint % 10000 < 8000 then 'train' else 'test' end part
  from feature_rows)
"""


def q(body: str) -> str:
    body = body.strip()
    if body.lower().startswith("with "):
        return "with " + FIXTURE_CTES.strip() + ",\n" + body[5:]
    return "with " + FIXTURE_CTES.strip() + "\n" + body


ORACLES: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLES[name] = q(body)


# ---------------------------------------------------------------- embedding
oracle("embed_append", """
select order_id, rpos pos, idx, val from raw_pairs
union all
select e.order_id, cast(coalesce(n.n, 0) + e.epos as int) pos, cast(6 + e.epos as int) idx, e.v val
from emb_vals e left join nraw n using (order_id)
""")

oracle("embed_only", """
select order_id, epos pos, cast(6 + epos as int) idx, v val from emb_vals
""")

oracle("embed_zero_numbering", """
select order_id, rpos pos, rpos idx, val from raw_pairs
union all
select e.order_id, cast(coalesce(n.n, 0) + e.epos as int) pos, cast(coalesce(n.n, 0) + e.epos as int) idx, e.v val
from emb_vals e left join nraw n using (order_id)
""")

oracle("embed_dense", """
select order_id, rpos pos, val from raw_pairs
union all
select e.order_id, cast(coalesce(n.n, 0) + e.epos as int) pos, e.v val
from emb_vals e left join nraw n using (order_id)
""")

oracle("embed_readme_form", """
with nall as (select order_id, cast(count(*) as int) n from sparse_rows group by order_id)
select order_id, cast(row_number() over (partition by order_id order by idx) - 1 as int) pos, val from sparse_rows
union all
select e.order_id, cast(n.n + e.epos as int) pos, e.v val from emb_vals e join nall n using (order_id)
""")

oracle("embed_width_check", """
select cast(count(*) as bigint) n_rows, cast(count(distinct raw_w) as bigint) raw_widths,
       cast(count(distinct emb_w) as bigint) emb_widths, cast(count(distinct raw_w + emb_w) as bigint) total_widths,
       cast(max(raw_w) as int) max_raw, cast(max(emb_w) as int) max_emb, cast(max(raw_w + emb_w) as int) max_total
from (select order_id,
             cast(sum(case when idx <= 5 then 1 else 0 end) as int) raw_w,
             cast(8 * sum(case when idx > 5 and val = 1 then 1 else 0 end) as int) emb_w
      from sparse_rows group by order_id) w
""")

oracle("embed_target_join", """
with tr as (select r.order_id, max(r.target) target from feature_rows r join split_tag s using (order_id)
            where s.part = 'train' group by r.order_id),
     out as (select order_id, rpos pos, val from raw_pairs
             union all
             select e.order_id, cast(coalesce(n.n, 0) + e.epos as int) pos, e.v val
             from emb_vals e left join nraw n using (order_id))
select o.order_id, tr.target, o.pos, o.val from out o left join tr using (order_id)
""")

oracle("embed_union_sets", """
select r.order_id, s.part "set", r.rpos pos, r.idx, r.val from raw_pairs r join split_tag s using (order_id)
union all
select e.order_id, s.part "set", cast(coalesce(n.n, 0) + e.epos as int) pos, cast(6 + e.epos as int) idx, e.v val
from emb_vals e left join nraw n using (order_id) join split_tag s using (order_id)
""")

oracle("latent_table", """
select cast(vec_id as int) idx,
  embedding[1]::double dim1, embedding[2]::double dim2, embedding[3]::double dim3, embedding[4]::double dim4,
  embedding[5]::double dim5, embedding[6]::double dim6, embedding[7]::double dim7, embedding[8]::double dim8
from embeddings
""")

# ---------------------------------------------------------------- rows
oracle("relabel_pm1", """
select order_id, cast(trunc(2 * cast(target as double) - 1) as int) label from feature_rows
""")

oracle("relabel_zero_only", """
select order_id, case when cast(target as double) = 0 then -1e0 else cast(target as double) end label
from feature_rows
""")

oracle("drop_zero", """
select order_id, cast(row_number() over (partition by order_id order by idx) - 1 as int) pos, idx, val
from sparse_rows where val <> 0
""")

oracle("feature_map", """
select idx, cast(row_number() over (order by idx) - 1 as int) pos
from (select distinct idx from sparse_rows where val <> 0) d
""")

oracle("reindex", """
with fmap as (select idx, cast(row_number() over (order by idx) - 1 as int) pos
              from (select distinct idx from sparse_rows where val <> 0) d)
select s.order_id, cast(row_number() over (partition by s.order_id order by s.idx) - 1 as int) p,
       m.pos idx, s.val
from sparse_rows s join fmap m using (idx) where s.val <> 0
""")

oracle("to_fm", """
with fmap as (select idx, cast(row_number() over (order by idx) - 1 as int) pos
              from (select distinct idx from sparse_rows where val <> 0) d)
select s.order_id, cast(trunc(2 * cast(s.label as double) - 1) as int) label,
       cast(row_number() over (partition by s.order_id order by s.idx) - 1 as int) p,
       m.pos idx, s.val
from sparse_rows s join fmap m using (idx) where s.val <> 0
""")

oracle("table_to_sparse", """
with t as (
  select order_id, cast(target as double) label, 0 idx, coalesce(f_bal, 0e0) val from feature_rows
  union all select order_id, cast(target as double), 1, coalesce(cast(f_flag as double), 0e0) from feature_rows
  union all select order_id, cast(target as double), 2, coalesce(cast(f_nation as double), 0e0) from feature_rows
  union all select order_id, cast(target as double), 3, coalesce(f_price, 0e0) from feature_rows
  union all select order_id, cast(target as double), 4, coalesce(cast(f_prio as double), 0e0) from feature_rows
  union all select order_id, cast(target as double), 5, coalesce(f_qty, 0e0) from feature_rows
  union all select order_id, cast(target as double), 6, coalesce(f_zero_disc, 0e0) from feature_rows
  union all select order_id, cast(target as double), 7, coalesce(cast(target_planted as double), 0e0) from feature_rows)
select order_id, label, cast(idx as int) idx, val from t where val <> 0
""")

oracle("to_libsvm_text", """
select order_id, cast(target as varchar) || ' 1:' || cast(f_flag as varchar)
  || ' 2:' || cast(f_nation as varchar) || ' 3:' || cast(f_prio as varchar)
  || ' 4:' || cast(cast(coalesce(f_zero_disc, 0) as bigint) as varchar)
  || ' 5:' || cast(cast(coalesce(f_qty, 0) as bigint) as varchar) line
from feature_rows
""")

oracle("to_dense", """
select order_id, 2 * cast(label as double) - 1 target,
       cast(row_number() over (partition by order_id order by idx) - 1 as int) pos, val
from sparse_rows
""")

oracle("to_ffm_text", """
select order_id, cast(min(label) as varchar) || ' ' || string_agg(
    cast(case when idx <= 5 then idx when idx <= 10 then 6 when idx <= 35 then 7 else 8 end as varchar)
    || ':' || cast(idx as varchar) || ':1', ' ' order by idx) line
from sparse_rows where idx > 5 and val <> 0 group by order_id
""")

oracle("dt_range_scan", """
select order_id, dt, target, f_price from feature_rows where dt between '19960101' and '19961231'
""")

oracle("dt_day_scan", """
select order_id, dt, target, f_price from feature_rows where dt = '19960315'
""")

oracle("numeric_fill", """
select user_id, target, target_planted, f_price, f_bal, coalesce(f_qty, 0) f_qty,
       coalesce(f_zero_disc, 0) f_zero_disc, f_nation, f_prio, f_flag from feature_rows
""")

oracle("cast_fill", """
select order_id, coalesce(cast(f_qty as double), 0e0) f_qty, coalesce(cast(f_zero_disc as double), 0e0) f_zero_disc,
       coalesce(cast(f_nation as double), 0e0) f_nation, coalesce(cast(f_prio as double), 0e0) f_prio
from feature_rows
""")

oracle("drop_ids", """
select target, target_planted, f_price, f_bal, f_qty, f_zero_disc, f_seg, f_nation, f_prio, f_flag
from feature_rows
""")

# ---------------------------------------------------------------- index / split
oracle("split_counts", """
select part, cast(count(*) as bigint) n from split_tag group by part
""")

oracle("split_half", """
select order_id, case when ('0x' || substr(md5('0:' || order_id),1,8))::bigint % 10000 < 5000
                      then 'train' else 'test' end part
from feature_rows
""")

oracle("row_col_count", """
select cast(count(*) as bigint) n_rows, 14 n_cols from feature_rows
""")

# ---------------------------------------------------------------- FM / FFM scoring and metrics
oracle("fm_score", """
with sc as (select idx, case when max(abs(val)) = 0 then 1e0 else max(abs(val)) end s
            from sparse_rows group by idx),
f as (select r.order_id, r.idx, r.val / sc.s x from sparse_rows r join sc using (idx) where r.val <> 0),
lin as (select cast(vec_id as int) idx, embedding[9]::double w from embeddings),
li as (select f.order_id, sum(lin.w * f.x) lin from f join lin using (idx) group by f.order_id),
q2 as (select f.order_id, l.d, sum(l.v * f.x) s1, sum(l.v * l.v * f.x * f.x) s2
       from f join lat l using (idx) group by f.order_id, l.d),
pw as (select order_id, sum(s1 * s1 - s2) / 2 pr from q2 group by order_id),
yy as (select ids.order_id, 0.1e0 + coalesce(li.lin, 0) + coalesce(pw.pr, 0) y
       from (select distinct order_id from sparse_rows) ids left join li using (order_id) left join pw using (order_id))
select order_id, round(y, 6) y, round(1 / (1 + exp(-y)), 6) p from yy
""")

SCORES = """
scores as (select case when o_orderstatus = 'F' then 1 else 0 end y, round(o_totalprice / 1000) s from orders),
probs as (select y, s, (s + 0.5e0) / (m.top + 1e0) p from scores, (select max(s) top from scores) m)
"""

oracle("auc", "with " + SCORES + """,
b as (select s k, sum(y) p, sum(1 - y) n from scores group by s),
w as (select p, n, coalesce(sum(n) over (order by k rows between unbounded preceding and 1 preceding), 0) nb from b)
select round(cast(sum(p * (nb + n / 2e0)) as double) / (cast(sum(p) as double) * sum(n)), 9) auc from w
""")

oracle("log_loss", "with " + SCORES + """
select round(avg(-(y * ln(greatest(least(p, 1 - 1e-15), 1e-15))
                   + (1 - y) * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)))), 6) log_loss from probs
""")

oracle("accuracy", "with " + SCORES + """
select round(avg(case when (case when p >= 0.5 then 1 else 0 end) = y then 1e0 else 0e0 end), 6) accuracy
from probs
""")

oracle("ffm_score", """
with r as (select order_id, idx,
                  case when idx <= 5 then idx when idx <= 10 then 6 when idx <= 35 then 7 else 8 end fld, val x
           from sparse_rows where idx > 5 and val = 1),
pr as (select a.order_id,
              sum(ea.embedding[4 * (b.fld - 1) + d]::double * eb.embedding[4 * (a.fld - 1) + d]::double * a.x * b.x) y
       from r a join r b on a.order_id = b.order_id and a.idx < b.idx
       join embeddings ea on ea.vec_id = a.idx join embeddings eb on eb.vec_id = b.idx, range(1, 5) t(d)
       group by a.order_id),
yy as (select ids.order_id, coalesce(pr.y, 0e0) y from (select distinct order_id from sparse_rows) ids
       left join pr using (order_id))
select order_id, round(y, 6) y, round(1 / (1 + exp(-y)), 6) p from yy
""")

# ---------------------------------------------------------------- feature transforms
oracle("bucketize", """
select order_id, case when f_qty is null then null when f_qty < 10 then 0e0 when f_qty < 100 then 1e0
                      else 2e0 end f_qty_bucket from feature_rows
""")

oracle("discretize", """
with c as (select distinct unnest(quantile_disc(f_bal, [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5,
                                                     0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95])) cut
           from feature_rows)
select order_id, cast((select count(*) from c where c.cut <= r.f_bal) as double) f_bal_bucket from feature_rows r
""")

SEG_RANK = """
seg_rank as (select f_seg, cast(row_number() over (order by n desc, f_seg) - 1 as double) f_seg_idx
             from (select f_seg, count(*) n from feature_rows group by f_seg) c)
"""

oracle("onehot", "with " + SEG_RANK + """
select r.order_id, cast((select count(*) from seg_rank) as int) vec_size, cast(s.f_seg_idx as int) hot_index
from feature_rows r join seg_rank s using (f_seg)
""")

oracle("string_index", "with " + SEG_RANK + """
select r.order_id, s.f_seg_idx from feature_rows r join seg_rank s using (f_seg)
""")

oracle("index_to_string", "with " + SEG_RANK + """
select r.order_id, s.f_seg f_seg_back from feature_rows r join seg_rank s using (f_seg)
""")

oracle("standardize", """
select order_id, round((f_price - m.mu) / m.sd, 6) f_price_std
from feature_rows, (select avg(f_price) mu, stddev_samp(f_price) sd from feature_rows) m
""")

oracle("binarize", """
select order_id, case when coalesce(f_zero_disc, 0) > 0 then 1e0 else 0e0 end x_bin from feature_rows
""")

oracle("normalize_l2", """
with e as (select vec_id, d, embedding[d]::double x from embeddings, range(1, 65) t(d)),
n as (select vec_id, sqrt(sum(x * x)) nrm from e group by vec_id)
select vec_id, cast(d - 1 as int) pos, round(case when nrm = 0 then x else x / nrm end, 6) val
from e join n using (vec_id)
""")

oracle("min_max", """
select order_id, round(case when m.hi = m.lo then 0.5 else (f_bal - m.lo) / (m.hi - m.lo) end, 6) f_bal_mm
from feature_rows, (select min(f_bal) lo, max(f_bal) hi from feature_rows) m
""")

oracle("max_abs", """
select order_id, round(f_bal / m.a, 6) f_bal_ma from feature_rows, (select max(abs(f_bal)) a from feature_rows) m
""")

oracle("assemble", """
select order_id, 0 pos, f_price val from feature_rows
union all select order_id, 1, f_bal from feature_rows
union all select order_id, 2, coalesce(f_qty, 0e0) from feature_rows
""")

oracle("copy_column", """
select order_id, f_flag f_flag_copy from feature_rows
""")

oracle("vector_index", """
with pr as (select f_prio, cast(row_number() over (order by f_prio) - 1 as double) c
            from (select distinct f_prio from feature_rows) d),
fl as (select f_flag, cast(row_number() over (order by f_flag) - 1 as double) c
       from (select distinct f_flag from feature_rows) d)
select r.order_id, 0 pos, pr.c val from feature_rows r join pr using (f_prio)
union all select order_id, 1, cast(f_nation as double) from feature_rows
union all select r.order_id, 2, fl.c from feature_rows r join fl using (f_flag)
""")

oracle("vector_slice", """
select order_id, 0 pos, f_price val from feature_rows
union all select order_id, 1, cast(f_flag as double) from feature_rows
""")

oracle("r_formula", "with " + SEG_RANK + """
, base as (select r.order_id, cast(r.target as double) label, s.f_seg_idx, r.f_price from feature_rows r
           join seg_rank s using (f_seg)),
  nseg as (select cast(count(*) as int) n from seg_rank)
select order_id, label, cast(p.i as int) pos, case when f_seg_idx = p.i then 1e0 else 0e0 end val
from base, nseg, range(0, 10) p(i) where p.i < nseg.n - 1
union all
select order_id, label, cast(nseg.n - 1 as int) pos, f_price val from base, nseg
""")

oracle("chisq_stats", """
with cells as (
  select 0 feature, cast(f_nation as double) v, target y from feature_rows
  union all select 1, cast(f_prio as double), target from feature_rows
  union all select 2, cast(f_flag as double), target from feature_rows),
obs as (select feature, v, y, count(*) o from cells group by feature, v, y),
rv as (select feature, v, sum(o) rs from obs group by feature, v),
cy as (select feature, y, sum(o) cs from obs group by feature, y),
tot as (select feature, sum(o) n from obs group by feature),
grid as (select rv.feature, rv.v, cy.y, rv.rs * cy.cs / cast(tot.n as double) e
         from rv join cy using (feature) join tot using (feature))
select g.feature, cast((select count(*) from rv where rv.feature = g.feature) - 1 as int) *
       cast((select count(*) from cy where cy.feature = g.feature) - 1 as int) dof,
       round(sum((coalesce(o.o, 0) - g.e) * (coalesce(o.o, 0) - g.e) / g.e), 6) statistic
from grid g left join obs o on o.feature = g.feature and o.v = g.v and o.y = g.y
group by g.feature
""")

oracle("transform_spec_exact", """
with f as (select order_id, coalesce(f_price, 0e0) f_price, coalesce(f_bal, 0e0) f_bal,
                  coalesce(f_qty, 0e0) f_qty, coalesce(f_zero_disc, 0e0) f_zero_disc,
                  coalesce(cast(f_flag as double), 0e0) f_flag, f_seg, f_nation, f_prio from feature_rows),
cb as (select distinct unnest(quantile_disc(f_bal, [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95])) cut from f),
cz as (select distinct unnest(quantile_disc(f_zero_disc, [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95])) cut from f),
st as (select avg(f_price) mu, stddev_samp(f_price) sd from f),
qb as (select order_id, case when f_qty < 10 then '0.0' when f_qty < 100 then '1.0' else '2.0' end b from f),
rq as (select b, row_number() over (order by n desc, b) - 1 r from (select b, count(*) n from qb group by b) c),
rs as (select f_seg v, row_number() over (order by n desc, f_seg) - 1 r
       from (select f_seg, count(*) n from f group by f_seg) c),
rn as (select f_nation v, row_number() over (order by n desc, cast(f_nation as varchar)) - 1 r
       from (select f_nation, count(*) n from f group by f_nation) c),
rp as (select f_prio v, row_number() over (order by n desc, cast(f_prio as varchar)) - 1 r
       from (select f_prio, count(*) n from f group by f_prio) c)
select f.order_id, round((f.f_price - st.mu) / st.sd, 6) f_price,
       cast((select count(*) from cb where cb.cut <= f.f_bal) as double) f_bal,
       cast((select count(*) from cz where cz.cut <= f.f_zero_disc) as double) f_zero_disc,
       f.f_flag, cast(rq.r as int) f_qty, cast(rs.r as int) f_seg, cast(rn.r as int) f_nation, cast(rp.r as int) f_prio
from f cross join st
join qb on qb.order_id = f.order_id join rq on rq.b = qb.b
join rs on rs.v = f.f_seg join rn on rn.v = f.f_nation join rp on rp.v = f.f_prio
""")

oracle("pipeline_end_to_end", """
select order_id, cast(sum(case when idx <= 5 then 1 else 0 end)
                      + 4 * sum(case when idx > 5 and val = 1 then 1 else 0 end) as int) n_values
from sparse_rows group by order_id
""")

oracle("drop_ids_prd", """
select order_id, target_planted, f_price, f_bal, f_qty, f_zero_disc, f_seg, f_nation, f_prio, f_flag from feature_rows
""")

# ---------------------------------------------------------------- training steps with a fixed model
SCORED = """
sc as (select idx, case when max(abs(val)) = 0 then 1e0 else max(abs(val)) end s from sparse_rows group by idx),
f as (select r.order_id, r.idx, r.val / sc.s x from sparse_rows r join sc using (idx) where r.val <> 0),
lin as (select cast(vec_id as int) idx, embedding[9]::double w from embeddings),
li as (select f.order_id, sum(lin.w * f.x) lin from f join lin using (idx) group by f.order_id),
q2 as (select f.order_id, l.d, sum(l.v * f.x) s1, sum(l.v * l.v * f.x * f.x) s2 from f join lat l using (idx) group by f.order_id, l.d),
pw as (select order_id, sum(s1 * s1 - s2) / 2 pr from q2 group by order_id),
yy as (select r.order_id, r.target, 0.1e0 + coalesce(li.lin, 0) + coalesce(pw.pr, 0) y
       from feature_rows r left join li using (order_id) left join pw using (order_id))
"""

oracle("fm_gradients", "with " + SCORED + """,
g as (select order_id, 1 / (1 + exp(-y)) - target g from yy)
select -1 idx, 0 d, round(sum(g), 6) g from g
union all
select f.idx, 0, round(sum(g.g * f.x), 6) from f join g using (order_id) group by f.idx
union all
select f.idx, cast(l.d + 1 as int), round(sum(g.g * f.x * q2.s1) - max(l.v) * sum(g.g * f.x * f.x), 6)
from f join g using (order_id) join lat l on l.idx = f.idx join q2 on q2.order_id = f.order_id and q2.d = l.d
group by f.idx, l.d
""")

oracle("als_step", "with " + SCORED + """,
e as (select order_id, case when target = 0 then -1e0 else 1e0 end - y e from yy),
p as (select f.order_id, f.idx, f.x, e.e, lin.w, l.v, f.x * (q2.s1 - l.v * f.x) h
      from f join e using (order_id) join lin on lin.idx = f.idx join lat l on l.idx = f.idx and l.d = 0
      join q2 on q2.order_id = f.order_id and q2.d = 0 where f.idx between 11 and 35)
select -1 factor, idx, round(sum((e + w * x) * x), 6) num, round(sum(x * x), 6) den from p group by idx
union all
select 0, idx, round(sum((e + v * h) * h), 6), round(sum(h * h), 6) from p group by idx
""")

# ---------------------------------------------------------------- text and table flows
LINES = """
lines as (select order_id, cast(target as varchar) || ' 1:' || cast(f_flag as varchar)
  || ' 2:' || cast(f_nation as varchar) || ' 3:' || cast(f_prio as varchar)
  || ' 4:' || cast(cast(coalesce(f_zero_disc, 0) as bigint) as varchar)
  || ' 5:' || cast(cast(coalesce(f_qty, 0) as bigint) as varchar) line, target from feature_rows),
ids as (select md5(line) || case when n = 1 then '' else '-' || cast(n - 1 as varchar) end row_id, target
        from (select line, target, row_number() over (partition by line) n from lines) a)
"""

oracle("split_text_rows", "with " + LINES + """
select row_id, cast(target as double) "label",
  case when ('0x' || substr(md5(row_id),1,8))::bigint % 10000 < 8000 then 'train' else 'test' end part from ids
""")

oracle("labels_only", "with " + LINES + """
select cast(target as int) "label", count(*) n, count(distinct row_id) ids from ids group by target
""")

oracle("libsvm_round_trip", """
select order_id, idx, round(val, 6) val from sparse_rows
""")

oracle("embedded_table", """
with tr as (select r.order_id, r.target from feature_rows r join split_tag s using (order_id) where s.part = 'train'),
vals as (select order_id, rpos pos, val from raw_pairs
         union all select e.order_id, cast(coalesce(n.n, 0) + e.epos as int), e.v from emb_vals e left join nraw n using (order_id))
select 'train' part, order_id, cast(tr.target as int) target, pos, val from vals join tr using (order_id)
union all
select 'prd', order_id, cast(tr.target as int), pos, val from vals left join tr using (order_id)
""")
