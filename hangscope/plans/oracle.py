"""DuckDB SQL that computes each registered query independently.

Every statement starts from the raw tables (orders, lineitem, part) and
re-derives the telemetry views of FIXTURES.md as CTEs; the query-specific
part follows.  Rules come from ``functions.rules`` rendered as CASE text.
"""

from __future__ import annotations

from hangscope.functions.rules import CATEGORY_RULES_1, CATEGORY_RULES_2, COMPONENT_RULES, sql_component_hit, \
    sql_first_rule

VIEWS = {
    "ping": """select o_orderkey ping_id,
 case when o_orderkey%97=0 then null when o_orderkey%4=1 then 'Darwin'
      when o_orderkey%4=2 then 'Linux' else 'Windows_NT' end os_name,
 concat(cast(o_custkey%3+6 as varchar),'.1.2') os_version,
 case when o_custkey%7=0 then 'x86' else 'x86-64' end arch,
 concat(cast(year(o_orderdate)*10000+month(o_orderdate)*100+1 as varchar),'100000') build_id,
 cast(floor(o_totalprice) as bigint)*10 since_ms,
 o_custkey, o_orderpriority, o_orderstatus
from orders""",
    "hang": """select ping_id, (ping_id*7919)%20000 duration,
 case o_orderpriority when '2-HIGH' then 'Gecko_Child' when '3-MEDIUM' then 'Compositor' else 'Gecko' end thread,
 case o_orderstatus when 'F' then 'nsTimer' when 'O' then 'IdleRunnable' else '' end runnable,
 o_custkey%2=0 pending_input, o_custkey%11=0 cpu_high, o_custkey%5=0 paint
from ping""",
    "frame": """select l_orderkey ping_id,
 row_number() over (partition by l_orderkey
   order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity)-1 pos,
 case when l_suppkey%20=0 then 'resource://devtools/x.js'
      when l_suppkey%10=0 then '(content script)' end label,
 case when l_suppkey%10<>0 then cast(l_partkey%12 as int) end module_index,
 case when l_suppkey%10<>0 then lower(hex(l_partkey*16+l_linenumber)) end "offset"
from lineitem""",
    "module": """select cast(r as int) module_index,
 concat('lib',cast(r as varchar),case when r%2=0 then '.pdb' else '.so' end) debug_name,
 case when r=9 then null else concat('ID',cast(r as varchar)) end breakpad_id
from (select distinct p_partkey%12 r from part where p_partkey%12<10) t""",
    "sym": """select concat('lib',cast(p_partkey%12 as varchar),case when p_partkey%12%2=0 then '.pdb' else '.so' end) debug_name,
 concat('ID',cast(p_partkey%12 as varchar)) breakpad_id,
 p_partkey*16 address,
 case p_partkey%9 when 0 then 'js::RunScript(JSContext*)' when 1 then 'mozilla::dom::Node'
  when 2 then 'nsRefreshDriver::Tick' when 3 then 'mozilla::places::History'
  when 4 then 'NS_ProcessNextEvent' when 5 then 'js::frontend::Parser'
  when 6 then 'mozilla::PresShell::DoReflow(bool)' when 7 then 'a/modules/PlacesUtils.jsm'
  else 'base::WaitableEvent::Wait()' end symbol
from part where p_partkey%12<8 and cast(floor(p_partkey/12) as int)%3<>0""",
    "symbol_line": """select debug_name, breakpad_id, address*2 line_no,
 concat('FUNC ',case when address%32=0 then 'm ' else '' end,lower(hex(address)),' 10 0 ',
        case when address%64=0 then 'shadowed by PUBLIC' else symbol end) line
from sym
union all
select debug_name, breakpad_id, address*2+1, concat('PUBLIC ',lower(hex(address)),' 0 ',symbol)
from sym where address%64=0""",
}

# Derived CTEs shared by most statements (all in DuckDB SQL).
DERIVED = {
    # valid pings with build date and platform
    "vping": """select ping_id, since_ms, substr(build_id,1,8) build_date,
 concat(os_name,':',split_part(os_version,'.',1),':',arch) platform
from ping where os_name is not null""",
    # symbolicated frames (M7 over the as-of join J1)
    "fs": """select f.ping_id, f.pos,
 case when f.label is not null then f.label when x.symbol is not null then x.symbol else '<unsymbolicated>' end func,
 case when f.label is not null then '' else coalesce(m.debug_name,'unknown') end lib
from frame f left join module m on m.module_index=f.module_index
left join (select d.debug_name, d.o, max_by(s.symbol, s.address) symbol
           from (select distinct m.debug_name, m.breakpad_id, f."offset" o, ('0x'||f."offset")::bigint v
                 from frame f join module m on m.module_index=f.module_index) d
           join sym s on s.debug_name=d.debug_name and s.breakpad_id=d.breakpad_id and s.address<=d.v
           group by 1,2) x on x.debug_name=m.debug_name and x.o=f."offset\"""",
    # symbolic stack text per ping
    "st": """select ping_id, string_agg(func||'@'||lib, '>' order by pos) stack from fs group by 1""",
    # usage hours per build date
    "u": """select build_date, sum(since_ms) usage_ms, sum(since_ms)/3600000.0e0 usage_h from vping group by 1""",
    # hangs of valid pings with ForcePaint copies
    "h": """select h.*, p.build_date, p.platform from hang h join vping p on h.ping_id=p.ping_id""",
    "h2": """select ping_id, duration, thread, runnable, pending_input, cpu_high, paint, build_date, platform from h
 union all
 select ping_id, duration, 'Gecko_Child_ForcePaint', runnable, pending_input, cpu_high, paint, build_date, platform
 from h where paint""",
    # per-ping stack labels: category (M2) and component (M6)
    "fcat": f"""select ping_id, pos, func, lib,
 {sql_first_rule('func', CATEGORY_RULES_1)} cat1,
 {sql_first_rule('func', CATEGORY_RULES_2)} cat2,
 {', '.join(f"{sql_component_hit('func', i)} c{i}" for i in range(len(COMPONENT_RULES)))}
from fs""",
    "stlab": f"""select ping_id,
 coalesce(max_by(cat1, case when cat1 is not null then pos end), max_by(cat2, case when cat2 is not null then pos end),
          'uncategorized') category,
 case {' '.join(f"when bool_or(c{i}) then '{COMPONENT_RULES[i][0]}'" for i in range(len(COMPONENT_RULES)))}
      else 'unknown_component' end component
from fcat group by 1""",
}

ORDER = ["ping", "hang", "frame", "module", "sym", "symbol_line", "vping", "fs", "st", "u", "h", "h2", "fcat", "stlab"]
ALL = {**VIEWS, **DERIVED}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the fixture views (and ``extra`` CTEs, in order)."""
    ctes = [f"{name} as ({ALL[name]})" for name in ORDER]
    for name, sql in (extra or {}).items():
        ctes.append(f"{name} as ({sql})")
    return "with " + ",\n".join(ctes) + "\n" + body
