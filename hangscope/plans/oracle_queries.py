"""Oracle SQL per registered query (DuckDB dialect, raw tables only)."""

from __future__ import annotations

from hangscope.plans.oracle import with_views

ORACLE: dict[str, str] = {}

ORACLE["hang_rates"] = with_views("""
select stack, runnable, thread, h2.build_date, pending_input, platform,
  sum(duration)/max(usage_h) ms_per_hour, count(*)/max(usage_h) count_per_hour
from h2 join st on st.ping_id=h2.ping_id join u on u.build_date=h2.build_date
where duration>=128 and duration<16000 and not cpu_high
group by 1,2,3,4,5,6""")

ORACLE["hang_sums"] = with_views("""
select stack, runnable, thread, h2.build_date, pending_input, platform,
  sum(duration) hang_ms, count(*) hang_count
from h2 join st on st.ping_id=h2.ping_id
where duration>=128 and duration<16000 and not cpu_high
group by 1,2,3,4,5,6""")

_HB = {
    "hb": """select h2.ping_id, h2.thread, h2.build_date,
  case when duration >= 128 then least(7, cast(floor(log2(duration)) as int) - 7) end bucket from h2""",
    "lab": """select hb.*, split_part(s.category, '.', 1) category, s.component
  from hb join stlab s on s.ping_id = hb.ping_id""",
    "lab2": """select ping_id, thread, build_date, bucket, category, component from lab
  union all select ping_id, thread, build_date, bucket, category, 'All Hangs' from lab""",
}
_BUCKET_SUMS = ", ".join(f"sum(case when bucket={i} then 1 else 0 end) h{i}" for i in range(8))
_BUCKET_RATES = ", ".join(f"sum(case when bucket={i} then 1 else 0 end)/max(u.usage_h) h{i}" for i in range(8))

ORACLE["duration_histogram"] = with_views(
    f"select component, thread, category, build_date, {_BUCKET_SUMS} from lab group by 1,2,3,4", _HB)
ORACLE["histogram_all_hangs"] = with_views(
    f"select component, thread, category, build_date, {_BUCKET_SUMS} from lab2 group by 1,2,3,4", _HB)
ORACLE["histogram_rates"] = with_views(
    f"""select component, thread, category, lab2.build_date, {_BUCKET_RATES}
 from lab2 join u on u.build_date = lab2.build_date group by 1,2,3,4""", _HB)

# ---- stack pruning ----
_PRUNE = {
    # hangs that count towards rates and have a stack
    "rh": """select h2.ping_id, h2.thread, h2.build_date, h2.duration, h2.runnable, h2.pending_input, h2.platform
  from h2 where duration>=128 and duration<16000 and not cpu_high and ping_id in (select ping_id from st)""",
    # every prefix of every stack: node text and the lib of its last frame
    "pf": """select a.ping_id, a.pos, string_agg(b.func||'@'||b.lib, '>' order by b.pos) node,
  max(case when b.pos=a.pos then b.lib end) lib
  from fs a join fs b on a.ping_id=b.ping_id and b.pos<=a.pos group by 1,2""",
    "nt": """select rh.thread, rh.build_date, pf.node, sum(rh.duration) v from rh join pf on pf.ping_id=rh.ping_id group by 1,2,3""",
    "rt": """select thread, build_date, sum(duration) root from rh group by 1,2""",
    "nd": """select rh.thread, rh.build_date, pf.node, sum(rh.duration)/max(u.usage_h) r
  from rh join pf on pf.ping_id=rh.ping_id join u on u.build_date=rh.build_date group by 1,2,3""",
    "nt2": """select a.thread, a.build_date, a.node, sum(b.r) v from nd a join nd b
  on a.thread=b.thread and a.node=b.node and b.build_date<=a.build_date group by 1,2,3""",
    "rd": """select rh.thread, rh.build_date, sum(rh.duration)/max(u.usage_h) r from rh join u on u.build_date=rh.build_date group by 1,2""",
    "rt2": """select a.thread, a.build_date, sum(b.r) root from rd a join rd b on a.thread=b.thread and b.build_date<=a.build_date group by 1,2""",
}


def _prune_sql(nt: str, rt: str) -> dict[str, str]:
    return {
        "pr": f"""select rh.ping_id, rh.thread, pf.pos, n.v,
  coalesce(lag(n.v) over (partition by rh.ping_id, rh.thread order by pf.pos), r.root) parent
  from rh join pf on pf.ping_id=rh.ping_id
  join {nt} n on n.thread=rh.thread and n.build_date=rh.build_date and n.node=pf.node
  join {rt} r on r.thread=rh.thread and r.build_date=rh.build_date""",
        "cut": """select ping_id, thread, min(case when not (v::double/parent::double > 0.01) then pos end) cut
  from pr group by 1,2""",
        "pruned": """select c.ping_id, c.thread,
  case when c.cut is null then st.stack when c.cut = 0 then '(other)@'||p1.lib
       else p0.node||'>(other)@'||p1.lib end stack
  from cut c join st on st.ping_id=c.ping_id
  left join pf p1 on p1.ping_id=c.ping_id and p1.pos=c.cut
  left join pf p0 on p0.ping_id=c.ping_id and p0.pos=c.cut-1""",
    }


_SAMPLES = """select p.stack, rh.thread, rh.build_date, runnable, pending_input, platform,
  sum(duration)/max(u.usage_h) sample_ms, count(*)/max(u.usage_h) sample_count
from rh join pruned p on p.ping_id=rh.ping_id and p.thread=rh.thread join u on u.build_date=rh.build_date
group by 1,2,3,4,5,6"""

ORACLE["prune_stacks_daily"] = with_views(_SAMPLES, {**_PRUNE, **_prune_sql("nt", "rt")})
ORACLE["prune_stacks_cumulative"] = with_views(_SAMPLES, {**_PRUNE, **_prune_sql("nt2", "rt2")})

# ---- single operators ----
from hangscope.functions.rules import CATEGORY_RULES_1 as _R1, CATEGORY_RULES_2 as _R2, sql_first_rule  # noqa: E402

_HANGS = "(select ping_id from vping where ping_id in (select ping_id from frame))"

ORACLE["scan_hang_pings"] = with_views("""select ping_id, substr(build_id,1,8) build_date from ping
 where substr(build_id,1,8) between '19940101' and '19961231'""")
ORACLE["scan_cutover_union"] = with_views("""select case when substr(build_id,1,8) <= '20180315' then 'OTHER' else 'bhr' end doc_type,
 count(*) n_pings from ping group by 1""")
ORACLE["sample_pings"] = with_views("""select ping_id from ping
 where ('0x'||substr(md5(cast(ping_id as varchar)),1,8))::bigint < 2147483648""")
ORACLE["project_properties"] = with_views("""select ping_id, os_name, os_version, arch, build_id, since_ms,
 10 n_modules, 1 n_hangs from ping""")
ORACLE["parse_symbol_records"] = with_views("""select debug_name, breakpad_id, 'FUNC' kind, address,
 case when address%64=0 then 'shadowed by PUBLIC' else symbol end symbol from sym
 union all select debug_name, breakpad_id, 'PUBLIC', address, symbol from sym where address%64=0""")
ORACLE["symbol_precedence"] = with_views("select debug_name, breakpad_id, address, symbol from sym")
ORACLE["truncate_symbol"] = with_views("select debug_name, address, length(symbol) symbol_length from sym")
ORACLE["symbol_path"] = with_views("""select debug_name, breakpad_id,
 case when breakpad_id is not null then debug_name||'/'||breakpad_id||'/'||regexp_replace(debug_name, '\\.pdb$', '')||'.sym' end path
 from module""")
ORACLE["valid_pings"] = with_views("select ping_id, build_id from ping where os_name is not null")
ORACLE["build_date"] = with_views("select ping_id, build_date from vping")
ORACLE["platform"] = with_views("select ping_id, platform from vping")
ORACLE["explode_hangs"] = with_views("""select h.ping_id, 0 hang_idx, h.duration, h.thread, h.runnable,
 coalesce(n.n, 0) n_frames from h left join (select ping_id, count(*) n from frame group by 1) n on n.ping_id=h.ping_id""")
ORACLE["stack_length_filter"] = with_views("""select ping_id, count(*) n_frames from frame
 where ping_id in (select ping_id from vping) group by 1 having count(*) between 1 and 299""")
ORACLE["frame_shape_filter"] = with_views("""select ping_id, row_number() over (partition by ping_id order by pos) - 1 pos,
 case when label is not null then 'label' else 'native' end kind, label, module_index, "offset"
 from (select f.*, l.l_quantity from frame f join (select l_orderkey, row_number() over (partition by l_orderkey
   order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity)-1 pos, l_quantity from lineitem) l
   on l.l_orderkey=f.ping_id and l.pos=f.pos) x
 where label is not null or l_quantity <= 45""")
ORACLE["decode_frames"] = with_views("""select f.ping_id, f.pos, f.label is not null pseudo,
 case when f.label is null then m.debug_name end debug_name, case when f.label is null then m.breakpad_id end breakpad_id,
 coalesce(f."offset", f.label) "offset"
 from frame f left join module m on m.module_index=f.module_index where f.ping_id in (select ping_id from vping)""")
ORACLE["module_index_lookup"] = with_views("""select f.ping_id, f.pos, f.module_index, m.debug_name, m.breakpad_id
 from frame f left join module m on m.module_index=f.module_index
 where f.label is null and f.ping_id in (select ping_id from vping)""")
ORACLE["force_paint_duplicate"] = with_views(f"select ping_id, thread from h2 where ping_id in {_HANGS}")
ORACLE["duration_bounds"] = with_views(f"""select ping_id, thread, duration from h2 where ping_id in {_HANGS}
 and duration >= 128 and duration < 16000""")
ORACLE["exclude_cpu_high"] = with_views(f"select ping_id, thread from h2 where ping_id in {_HANGS} and not cpu_high")
ORACLE["pending_input"] = with_views(f"select ping_id, thread, pending_input from h2 where ping_id in {_HANGS}")
ORACLE["process_type"] = with_views(f"""select distinct thread,
 case when thread in ('Gecko_Child', 'Gecko_Child_ForcePaint') then 'tab' else 'default' end process_type
 from h2 where ping_id in {_HANGS}""")
_DF = """select distinct f.label is not null pseudo, case when f.label is null then m.debug_name end debug_name,
 case when f.label is null then m.breakpad_id end breakpad_id, coalesce(f."offset", f.label) "offset"
 from frame f left join module m on m.module_index=f.module_index where f.ping_id in (select ping_id from vping)"""
ORACLE["distinct_frames"] = with_views(_DF)
ORACLE["offsets_by_module"] = with_views(f"""select debug_name, breakpad_id, count(distinct "offset") n_offsets,
 min(('0x'||"offset")::bigint) min_offset, max(('0x'||"offset")::bigint) max_offset
 from ({_DF}) d where not pseudo and debug_name is not null group by 1,2""")
ORACLE["usage_hours_by_date"] = with_views("select build_date, usage_ms, usage_h from u")
ORACLE["symbol_asof_join"] = with_views(f"""select d.debug_name, d.breakpad_id, d."offset",
 max_by(s.symbol, s.address) symbol
 from ({_DF}) d left join sym s on s.debug_name=d.debug_name and s.breakpad_id=d.breakpad_id
   and s.address <= ('0x'||d."offset")::bigint
 where not d.pseudo and d.debug_name is not null group by 1,2,3""")
ORACLE["symbolicate_special"] = with_views("""select distinct f.label is not null pseudo,
 case when f.label is null then m.debug_name end debug_name, coalesce(f."offset", f.label) "offset", fs.func, fs.lib
 from frame f join fs on fs.ping_id=f.ping_id and fs.pos=f.pos left join module m on m.module_index=f.module_index
 where f.ping_id in (select ping_id from vping)""")
ORACLE["hex_offset"] = with_views(f"""select distinct "offset", ('0x'||"offset")::bigint value from ({_DF}) d
 where not pseudo""")
ORACLE["frame_symbol_left_join"] = with_views("select ping_id, pos, func, lib from fs where ping_id in (select ping_id from vping)")
ORACLE["reassemble_stacks"] = with_views("select ping_id, stack from st where ping_id in (select ping_id from vping)")
ORACLE["categorize_stack"] = with_views("select ping_id, category from stlab where ping_id in (select ping_id from vping)")
ORACLE["category_root"] = with_views("""select ping_id, split_part(category, '.', 1) category_root from stlab
 where ping_id in (select ping_id from vping)""")
ORACLE["tracking_component"] = with_views("select ping_id, component from stlab where ping_id in (select ping_id from vping)")
ORACLE["match_kinds"] = with_views(f"""select func, {sql_first_rule('func', _R1)} rule_set_1,
 {sql_first_rule('func', _R2)} rule_set_2 from (select distinct func from fs where ping_id in (select ping_id from vping)) t""")
ORACLE["duration_bucket"] = with_views("""select ping_id, duration,
 case when duration >= 128 then least(7, cast(floor(log2(duration)) as int) - 7) end bucket from h""")
ORACLE["usage_hours_join"] = with_views("""select thread, h2.build_date, sum(duration) hang_ms, sum(duration)/max(usage_h) ms_per_hour
 from h2 join st on st.ping_id=h2.ping_id join u on u.build_date=h2.build_date
 where duration>=128 and duration<16000 and not cpu_high group by 1,2""")
ORACLE["positive_ms"] = with_views("""select stack, runnable, thread, h2.build_date, pending_input, platform,
  sum(duration)/max(usage_h) ms_per_hour
from h2 join st on st.ping_id=h2.ping_id join u on u.build_date=h2.build_date
where duration>=128 and duration<16000 and not cpu_high
group by 1,2,3,4,5,6 having sum(duration) > 0""")

# ---- profile tables (cumulative pruning) ----
_PROF = {**_PRUNE, **_prune_sql("nt2", "rt2"),
    "cutk": """select c.ping_id, c.thread, c.cut from cut c""",
    "pnodes": """select c.thread, pf.node, fs.func, fs.lib, coalesce(p0.node, '') prefix
  from cutk c join pf on pf.ping_id=c.ping_id and (c.cut is null or pf.pos < c.cut)
  join fs on fs.ping_id=pf.ping_id and fs.pos=pf.pos
  left join pf p0 on p0.ping_id=pf.ping_id and p0.pos=pf.pos-1
  union
  select c.thread, case when c.cut = 0 then '(other)@'||p1.lib else p0.node||'>(other)@'||p1.lib end,
    '(other)', p1.lib, coalesce(p0.node, '')
  from cutk c join pf p1 on p1.ping_id=c.ping_id and p1.pos=c.cut
  left join pf p0 on p0.ping_id=c.ping_id and p0.pos=c.cut-1""",
    "pcat": """select c.ping_id, c.thread, coalesce(max_by(f.cat1, case when f.cat1 is not null then f.pos end),
    max_by(f.cat2, case when f.cat2 is not null then f.pos end)) category
  from cutk c left join fcat f on f.ping_id=c.ping_id and (c.cut is null or f.pos < c.cut) group by 1,2""",
    "psamp": """select rh.thread, rh.build_date, p.stack, rh.runnable, rh.pending_input, rh.platform, pc.category,
    rh.duration, rh.ping_id
  from rh join pruned p on p.ping_id=rh.ping_id and p.thread=rh.thread
  join pcat pc on pc.ping_id=rh.ping_id and pc.thread=rh.thread""",
}
ORACLE["string_table"] = with_views("""select thread, func string from pnodes
 union select distinct thread, '(root)' from rh
 union select thread, runnable from psamp union select thread, platform from psamp
 union select thread, category from psamp where category is not null""", _PROF)
ORACLE["lib_table"] = with_views("""select distinct thread, regexp_replace(lib, '\\.pdb$', '') name, lib "debugName"
 from pnodes where lib is not null""", _PROF)
ORACLE["func_table"] = with_views("""select distinct thread, func, lib from pnodes
 union select distinct thread, '(root)', null from rh""", _PROF)
ORACLE["stack_table"] = with_views("select distinct thread, func, lib, prefix from pnodes", _PROF)
ORACLE["reconstruct_stacks"] = with_views("""select distinct thread, node stack from pnodes
 union select distinct thread, '' from rh""", _PROF)
ORACLE["sample_table"] = with_views("""select distinct thread, stack, runnable, pending_input "userInteracting",
 platform, category from psamp""", _PROF)
ORACLE["sample_category"] = with_views("select distinct thread, stack, category from psamp", _PROF)
ORACLE["dates_table"] = with_views("""select thread, psamp.build_date date, stack, runnable, pending_input "userInteracting",
 platform, sum(duration)/max(u.usage_h) sample_ms, count(*)/max(u.usage_h) sample_count
 from psamp join u on u.build_date=psamp.build_date group by 1,2,3,4,5,6""", _PROF)
ORACLE["minimal_profile"] = with_views("""select thread, date, stack, sample_count from (
 select thread, psamp.build_date date, stack, runnable, pending_input, platform, count(*)/max(u.usage_h) sample_count
 from psamp join u on u.build_date=psamp.build_date
 where not (thread = 'Gecko_Child' and not pending_input) group by 1,2,3,4,5,6) t""", _PROF)
ORACLE["pack_profile"] = with_views("""select t.thread "name", case when t.thread in ('Gecko_Child','Gecko_Child_ForcePaint')
 then 'tab' else 'default' end process_type,
 (select count(distinct lib) from pnodes p where p.thread=t.thread) n_libs,
 (select count(*) from (select distinct func, lib from pnodes p where p.thread=t.thread)) + 1 n_funcs,
 (select count(distinct node) from pnodes p where p.thread=t.thread) + 1 n_stacks,
 (select count(*) from (select distinct stack, runnable, pending_input, platform from psamp p where p.thread=t.thread)) n_samples,
 (select count(*) from (select func s from pnodes p where p.thread=t.thread union select '(root)'
   union select runnable from psamp p where p.thread=t.thread union select platform from psamp p where p.thread=t.thread
   union select category from psamp p where p.thread=t.thread and category is not null)) n_strings,
 (select count(distinct build_date) from psamp p where p.thread=t.thread) n_dates
 from (select distinct thread from rh) t""", _PROF)

# ---- crash source ----
_CRASH = {
    "cframe": """select f.ping_id, f.pos, f.module_index,
  case when f.module_index < 10 then (f.module_index + 1) * 1048576 else 0 end base,
  ('0x'||f."offset")::bigint v from frame f where f.label is null""",
    "cpos": """select ping_id, row_number() over (partition by ping_id order by pos desc) - 1 cpos, pos, module_index,
  '0x'||lower(hex(v)) "offset" from cframe""",
    "cst": """select c.ping_id, string_agg(fs.func||'@'||fs.lib, '>' order by c.cpos) stack
  from cpos c join fs on fs.ping_id=c.ping_id and fs.pos=c.pos group by 1""",
    "cu": """select build_date, count(*)*86400/3600000.0e0 usage_h from vping group by 1""",
}
ORACLE["scan_crash_pings"] = with_views("""select ping_id, substr(build_id,1,8) "submissionDate",
 case o_orderpriority when '2-HIGH' then 'Gecko_Child' when '3-MEDIUM' then 'Compositor' else 'Gecko' end process_type
 from ping""")
ORACLE["crash_frame_rebase"] = with_views("""select ping_id, cpos pos, module_index, "offset" from cpos
 where ping_id in (select ping_id from vping)""", _CRASH)
ORACLE["crash_to_hang"] = with_views("""select v.ping_id, h.thread, 1::bigint duration, 'dummy_runnable' runnable,
 h.thread process, coalesce(n.n, 0) n_frames
 from vping v join hang h on h.ping_id=v.ping_id join (select distinct l_orderkey from lineitem) o on o.l_orderkey=v.ping_id
 left join (select ping_id, count(*) n from cframe group by 1) n on n.ping_id=v.ping_id""", _CRASH)
ORACLE["crash_hang_rates"] = with_views("""select cst.stack, 'dummy_runnable' runnable, h.thread, v.build_date, false pending_input,
 v.platform, count(*)/max(cu.usage_h) ms_per_hour, count(*)/max(cu.usage_h) count_per_hour
 from vping v join hang h on h.ping_id=v.ping_id join cst on cst.ping_id=v.ping_id join cu on cu.build_date=v.build_date
 group by 1,2,3,4,5,6""", _CRASH)

ORACLE["crash_window_rates"] = with_views("""select cst.stack, 'dummy_runnable' runnable, h.thread, v.build_date, false pending_input,
 v.platform, count(*)/max(wu.usage_h) ms_per_hour, count(*)/max(wu.usage_h) count_per_hour
 from win v join hang h on h.ping_id=v.ping_id join cst on cst.ping_id=v.ping_id join wu on wu.build_date=v.build_date
 group by 1,2,3,4,5,6""", {**_CRASH,
    "win": """select * from vping where build_date between '19950101' and '19951130'
  and ('0x'||substr(md5(cast(ping_id as varchar)),1,8))::bigint < 2147483648""",
    "wu": "select build_date, count(*)*86400/3600000.0e0 usage_h from win group by 1"})
ORACLE["crash_rebase_high"] = with_views("""select ping_id, pos, module_index, case when sign_ < 0 then '-0x' else '0x' end
   ||lower(hex(case when sign_ < 0 then 2*v else v end)) "offset"
 from (select *, case when module_index % 3 = 2 then -1 else 1 end sign_ from cframe where module_index < 10 and v > 0) x""", _CRASH)

# ---- sinks, increments, merges ----
_DAILY = with_views(_SAMPLES, {**_PRUNE, **_prune_sql("nt", "rt")})
ORACLE["finalize_profiles"] = _DAILY
ORACLE["post_sample"] = with_views("""select * from (""" + _SAMPLES + """) s
 where ('0x'||substr(md5(concat_ws('|', thread, build_date, stack, runnable, cast(pending_input as varchar), platform)),1,8))::bigint
   < 2147483648""", {**_PRUNE, **_prune_sql("nt", "rt")})
ORACLE["write_profile"] = with_views("""select t.thread "name",
 (select count(*) from (select distinct func, lib from pnodes p where p.thread=t.thread)) + 1 n_funcs,
 (select count(distinct node) from pnodes p where p.thread=t.thread) + 1 n_stacks,
 (select count(*) from (select distinct stack, runnable, pending_input, platform from psamp p where p.thread=t.thread)) n_samples
 from (select distinct thread from rh) t""", _PROF)
ORACLE["write_split"] = with_views("""select thread, 'stringArray' section, count(*) "rows" from (
   select thread, func s from pnodes union select distinct thread, '(root)' from rh
   union select thread, runnable from psamp union select thread, platform from psamp
   union select thread, category from psamp where category is not null) x group by 1
 union all select thread, 'libs', count(distinct lib) from pnodes where lib is not null group by 1
 union all select thread, 'funcTable', count(*) + 1 from (select distinct thread, func, lib from pnodes) x group by 1
 union all select thread, 'stackTable', count(distinct node) + 1 from pnodes group by 1
 union all select thread, 'sampleTable', count(*) from (select distinct thread, stack, runnable, pending_input, platform from psamp) x group by 1
 union all select thread, 'dates', count(*) from (select distinct thread, build_date, stack, runnable, pending_input, platform from psamp) x group by 1""", _PROF)
ORACLE["merge_histograms"] = with_views(f"""select component, thread, category, lab2.build_date, {_BUCKET_RATES}
 from lab2 join u on u.build_date = lab2.build_date group by 1,2,3,4""", _HB)
ORACLE["merge_usage_hours"] = with_views("""select build_date, sum(usage_h) usage_h from (
 select build_date, usage_h from u where build_date <= '19951231'
 union all select build_date, usage_h from u where build_date >= '19950101') x group by 1""")

ORACLE["stack_node_totals"] = with_views("""select x.thread, x.build_date, x.depth, x.func, x.lib, x.node_ms, t.root_ms from (
 select rh.thread, rh.build_date, pf.node, pf.pos depth, fs.func, fs.lib, sum(rh.duration) node_ms
 from rh join pf on pf.ping_id=rh.ping_id join fs on fs.ping_id=pf.ping_id and fs.pos=pf.pos group by 1,2,3,4,5,6) x
 join (select thread, build_date, sum(duration) root_ms from rh group by 1,2) t on t.thread=x.thread and t.build_date=x.build_date""", _PRUNE)
ORACLE["sample_table_by_date"] = with_views("""select p.stack, rh.thread, rh.build_date, runnable, pending_input, platform,
  sum(duration) hang_ms, count(*) hang_count
from rh join pruned p on p.ping_id=rh.ping_id and p.thread=rh.thread group by 1,2,3,4,5,6""",
    {**_PRUNE, **_prune_sql("nt", "rt")})
ORACLE["profile_post_sample_ignored"] = ORACLE["sample_table_by_date"]
ORACLE["minimal_sample_filter"] = with_views("""select * from (
 select p.stack, rh.thread, rh.build_date, runnable, pending_input, platform, count(*)/max(u.usage_h) sample_count
 from rh join pruned p on p.ping_id=rh.ping_id and p.thread=rh.thread join u on u.build_date=rh.build_date
 group by 1,2,3,4,5,6) s where not (thread = 'Gecko_Child' and not pending_input)""",
    {**_PRUNE, **_prune_sql("nt", "rt")})
ORACLE["histogram_add"] = with_views(f"""select component, thread, category, build_date, {_BUCKET_SUMS} from (
 select * from lab2 where build_date <= '19951231' union all select * from lab2 where build_date >= '19950101') x
 group by 1,2,3,4""", _HB)
ORACLE["read_profile"] = with_views("""select p.stack, rh.thread, rh.build_date, runnable, pending_input, platform,
  sum(duration) hang_ms, count(*) hang_count
from rh join pruned p on p.ping_id=rh.ping_id and p.thread=rh.thread
where rh.build_date between '19950101' and '19961231' group by 1,2,3,4,5,6""", {**_PRUNE, **_prune_sql("nt", "rt")})
ORACLE["module_key"] = with_views("""select debug_name, breakpad_id, debug_name||'\\'||coalesce(breakpad_id, 'None') module_key
 from module""")

# ---- written and read again ----
_REREAD = with_views("""select stack, thread, psamp.build_date, runnable, pending_input, platform,
 sum(duration)/max(u.usage_h) sample_ms, count(*)/max(u.usage_h) sample_count
 from psamp join u on u.build_date=psamp.build_date group by 1,2,3,4,5,6""", _PROF)
ORACLE["reingest_documents"] = ORACLE["reingest_chunks"] = ORACLE["reingest_split"] = _REREAD
ORACLE["prune_stacks_stepwise"] = ORACLE["prune_stacks_cumulative"]
ORACLE["finalize_written"] = with_views("""select case when cut is null then stack when cut = 1 then '(other)@'||lib
   else replace(array_to_string(list_slice(frames, 1, cut - 1), '>'), '<unsymbolicated@', '<unsymbolicated>@')||'>(other)@'||lib end stack,
  thread, build_date, runnable, pending_input, platform, sum(sample_ms) sample_ms, sum(sample_count) sample_count
 from (select s.*, c.cut, regexp_extract(frames[c.cut], '@([^@]*)$', 1) lib from split s
       left join cuts c on c.profile=s.profile and c.thread=s.thread and c.stack=s.stack) x
 group by 1,2,3,4,5,6""", {**_PRUNE, **_prune_sql("nt", "rt"),
    "daily": _SAMPLES,
    "split": """select *, case when build_date <= '19951231' then 'first' else 'second' end profile, string_split(replace(stack, '<unsymbolicated>', '<unsymbolicated'), '>') frames from daily""",
    "pfx": """select profile, thread, stack, sample_ms, pos, array_to_string(list_slice(frames, 1, pos), '>') node,
  case when pos = 1 then '' else array_to_string(list_slice(frames, 1, pos - 1), '>') end parent
  from (select *, unnest(range(1, len(frames) + 1)) pos from split) x""",
    "ptot": """select profile, thread, node, sum(sample_ms) v from pfx group by 1,2,3
  union all select profile, thread, '', sum(sample_ms) from split group by 1,2""",
    "cuts": """select p.profile, p.thread, p.stack, min(p.pos) cut from pfx p
  join ptot n on n.profile=p.profile and n.thread=p.thread and n.node=p.node
  join ptot q on q.profile=p.profile and q.thread=p.thread and q.node=p.parent
  where not (n.v / q.v > 0.01) group by 1,2,3"""})
ORACLE["symbol_store"] = with_views("""select debug_name, breakpad_id, address, symbol from sym
 where (debug_name, breakpad_id) in (select m.debug_name, m.breakpad_id from frame f join module m on m.module_index=f.module_index
   where f.module_index < 5 and f.ping_id in (select ping_id from vping))""")
ORACLE["symbol_store_asof"] = ORACLE["symbol_asof_join"]
ORACLE["offset_sets"] = with_views(f"""select distinct debug_name, breakpad_id, ('0x'||"offset")::bigint "value"
 from ({_DF}) d where not pseudo and debug_name is not null""")
_MODULES = """select distinct p_name||case when p_partkey%2=0 then '.pdb' else '.so' end debug_name,
 case when p_partkey%10<>9 then p_brand||'*'||cast(p_partkey as varchar) end breakpad_id from part"""
_quoted = lambda c: f"replace(url_encode({c}), '%20', '+')"
ORACLE["symbol_path"] = f"""select debug_name, breakpad_id, case when breakpad_id is not null then {_quoted('debug_name')}||'/'||{_quoted('breakpad_id')}
 ||'/'||{_quoted("regexp_replace(debug_name, '[.]pdb$', '')||'.sym'")} end "path" from ({_MODULES}) m"""
ORACLE["module_key"] = f"""select debug_name, breakpad_id, debug_name||'\\'||coalesce(breakpad_id, 'None') module_key from ({_MODULES}) m"""
ORACLE["json_pings"] = with_views("""select p.ping_id, os_name, os_version, arch, substr(build_id,1,8) build_date, since_ms, 10 n_modules,
 duration, thread, runnable, cast(pending_input as int)+cast(cpu_high as int)+cast(paint as int) n_annotations,
 coalesce(n, 0) n_frames, coalesce(frames, '') frames
 from ping p join hang h on h.ping_id=p.ping_id
 left join (select f.ping_id, count(*) n, string_agg(coalesce(label, cast(module_index as varchar)||':'||"offset"), ',' order by f.pos) frames
   from frame f join (select l_orderkey, row_number() over (partition by l_orderkey
     order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity)-1 pos, l_quantity from lineitem) l
     on l.l_orderkey=f.ping_id and l.pos=f.pos
   where label is not null or l_quantity <= 45 group by 1) x on x.ping_id=p.ping_id
 where p.ping_id%11<>0 and p.ping_id%13<>0 and p.ping_id%17<>0 and p.ping_id%19<>0 and os_name is not null
   and substr(build_id,1,8) between '19930101' and '19971231'""")
ORACLE["json_ping_rejects"] = with_views("""select ping_id, case when ping_id%17=0 then 'not JSON' when os_name is null then 'os name is not text'
 when ping_id%11=0 then 'build id is not text' else 'time since last ping is not an integer' end reason
 from ping where ping_id%17=0 or os_name is null or ping_id%11=0 or ping_id%13=0 or ping_id%19=0""")
ORACLE["job_counters"] = with_views("""select 'pings' counted, 'rows' metric, count(*) "value" from ping
 union all select 'pings', 'rejected', count(*) from ping where os_name is null
 union all select 'symbol_lines', 'rejected', count(*) from sym where (address/16)::bigint % 3 = 1
 union all select 'rates', 'rows', count(*) from keys
 union all select 'rates', 'without_usage_hours', count(*) from keys where build_date >= '19980101'""", {
    # a symbol whose FUNC line is bad keeps its PUBLIC line, if it has one
    "sym3": "select * from sym where (address/16)::bigint % 3 <> 1 or address % 64 = 0",
    "fs3": """select f.ping_id, f.pos,
 case when f.label is not null then f.label when x.symbol is not null then x.symbol else '<unsymbolicated>' end func,
 case when f.label is not null then '' else coalesce(m.debug_name,'unknown') end lib
from frame f left join module m on m.module_index=f.module_index
left join (select d.debug_name, d.o, max_by(s.symbol, s.address) symbol
           from (select distinct m.debug_name, m.breakpad_id, f."offset" o, ('0x'||f."offset")::bigint v
                 from frame f join module m on m.module_index=f.module_index) d
           join sym3 s on s.debug_name=d.debug_name and s.breakpad_id=d.breakpad_id and s.address<=d.v
           group by 1,2) x on x.debug_name=m.debug_name and x.o=f."offset\"""",
    "st3": """select ping_id, string_agg(func||'@'||lib, '>' order by pos) stack from fs3 group by 1""",
    "keys": """select distinct st3.stack, runnable, thread, build_date, pending_input, platform from h2 join st3 on st3.ping_id=h2.ping_id
  where duration>=128 and duration<16000 and not cpu_high"""})
ORACLE["tracked_stats_store"] = ORACLE["merge_histograms"]
