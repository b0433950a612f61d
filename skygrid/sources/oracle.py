"""Plain SQL views of the shared test tables, in the shapes of ``adapters``, for the second engine."""

from skygrid.params import PARTITION_MERGES

_MERGES = ", ".join(f"({lone}, {home})" for lone, home in PARTITION_MERGES.items())

VIEWS = {
    "v_stations": """
  select s_suppkey as sid, concat('ST', s_suppkey) as stationid,
    case s_suppkey % 4 when 0 then 'aemet' when 1 then 'meteocat' when 2 then 'meteogalicia' else 'ria' end as service,
    300000e0 + ((s_suppkey * 940) % 997) * 500e0 as x, 4100000e0 + ((s_suppkey * 44) % 997) * 500e0 as y,
    cast((s_suppkey * 37) % 2000 as double) as elevation,
    cast((s_suppkey * 13) % 45 as double) as slope, cast((s_suppkey * 31) % 360 as double) as aspect
  from supplier""",
    "v_raw_obs": """
  select l_suppkey as sid, cast(l_shipdate as date) as dates,
    min(l_quantity) / 2e0 - 5e0 as mintemperature,
    min(l_quantity) / 2e0 - 3e0 + max(l_discount) * 100e0 as maxtemperature,
    case when l_suppkey % 17 = 0 or min(l_linenumber) <= 3 then 0e0 else max(l_quantity) / 5e0 end as precipitation,
    case when l_suppkey % 19 = 0 then 0e0 when max(l_returnflag) = 'N' then null else min(l_tax) * 100e0 end as windspeed,
    cast(min(l_partkey) % 360 as double) as winddirection,
    20e0 + min(l_discount) * 200e0 as minrelativehumidity, 60e0 + max(l_discount) * 300e0 as maxrelativehumidity,
    5e0 + max(l_tax) * 200e0 as radiation
  from lineitem group by l_suppkey, cast(l_shipdate as date)""",
    "v_obs": """
  select o.*, s.stationid, s.service, s.x, s.y, s.elevation, s.slope, s.aspect
  from v_raw_obs o join v_stations s on o.sid = s.sid""",
    "v_norm": """
  select *, 237.3e0 * q / (17.27e0 - q) as dewtemperature from (
    select *, ln(0.6108e0 * exp(17.27e0 * meantemperature / (meantemperature + 237.3e0))
                 * greatest(meanrelativehumidity, 1e0) / 100e0 / 0.6108e0) as q
    from (select *, 0.606e0 * maxtemperature + 0.394e0 * mintemperature as meantemperature,
            (minrelativehumidity + maxrelativehumidity) / 2e0 as meanrelativehumidity from v_obs))""",
    "v_sums": """
  select stationid, coalesce(sum(precipitation), 0e0) as psum, coalesce(sum(windspeed), 0e0) as wsum
  from v_obs group by stationid""",
    "v_masked": """
  select o.* exclude (precipitation, windspeed, winddirection),
    case when s.psum > 0 then o.precipitation end as precipitation,
    case when s.wsum > 0 then o.windspeed end as windspeed,
    case when s.wsum > 0 then o.winddirection end as winddirection
  from v_norm o join v_sums s on o.stationid = s.stationid""",
    "v_grid": "select cast(ceil(sqrt(count(*))) as bigint) as ncol from part",
    "v_cells": """
  select p_partkey as cell_id, cast(floor(p_partkey / ncol) as bigint) as r, p_partkey % ncol as c,
    300137e0 + (p_partkey % ncol + 5e-1) * (500000e0 / ncol) as x,
    4100137e0 + (floor(p_partkey / ncol) + 5e-1) * (500000e0 / ncol) as y,
    cast((p_partkey * 53) % 1500 as double) as elevation
  from part cross join v_grid""",
    "v_topo0": """
  select *, cast((cell_id * 7) % 30 as double) as slope, cast((cell_id * 29) % 360 as double) as aspect,
    cast((cell_id * 11) % 21 as double) - 10e0 as tpi,
    cast(least(floor((4600137e0 - y) / (500000e0 / 15e0)), 14) * 14
       + least(floor((x - 300137e0) / (500000e0 / 14e0)), 13) + 1 as int) as raw_partition
  from v_cells""",
    "v_topo": f"""
  select * exclude (raw_partition, lone, home), coalesce(home, raw_partition) as partition
  from v_topo0 left join (values {_MERGES}) as merges(lone, home) on lone = raw_partition""",
    "v_boxes": """
  select partition as i_step, min(x) as xmin, max(x) as xmax, min(y) as ymin, max(y) as ymax, count(*) as topo_ncells
  from v_topo group by partition""",
    "v_member": """
  select s.stationid, b.i_step from v_stations s join v_boxes b
  on power(greatest(b.xmin - s.x, 0e0, s.x - b.xmax), 2) + power(greatest(b.ymin - s.y, 0e0, s.y - b.ymax), 2)
     <= 99000e0 * 99000e0""",
    "v_placed": "select o.*, m.i_step from v_masked o join v_member m on o.stationid = m.stationid",
    "v_centres": """
  select n_nationkey as rid, n_name as name, n_regionkey as province,
    350000 + (n_nationkey % 5) * 100000 as cx, cast(4150000 + floor(n_nationkey / 5) * 100000 as bigint) as cy from nation""",
    "v_regions": """
  select rid, name, province, cx, cy, concat('POLYGON ((',
    cx-50000,' ',cy-30000,', ',cx-30000,' ',cy-50000,', ',cx+30000,' ',cy-50000,', ',cx+50000,' ',cy-30000,', ',
    cx+50000,' ',cy+30000,', ',cx+30000,' ',cy+50000,', ',cx-30000,' ',cy+50000,', ',cx-50000,' ',cy+30000,', ',
    cx-50000,' ',cy-30000,')',
    case when rid % 5 = 0 then concat(', (',cx-10000,' ',cy-10000,', ',cx+10000,' ',cy-10000,', ',cx+10000,' ',cy+10000,', ',
      cx-10000,' ',cy+10000,', ',cx-10000,' ',cy-10000,')') else '' end, ')') as wkt from v_centres""",
    "v_inside": """
  select g.rid, c.cell_id from v_cells c join v_centres g
  on abs(c.x - g.cx) < 50000 and abs(c.y - g.cy) < 50000 and abs(c.x - g.cx) + abs(c.y - g.cy) < 80000
    and not (g.rid % 5 = 0 and abs(c.x - g.cx) < 10000 and abs(c.y - g.cy) < 10000)""",
    "v_interp": """
  select *, 0.606e0 * maxtemperature + 0.394e0 * mintemperature as meantemperature,
    (minrelativehumidity + maxrelativehumidity) / 2e0 as meanrelativehumidity,
    maxtemperature - mintemperature as thermalamplitude
  from (
    select l_partkey as cell_id, cast(l_shipdate as date) as dates,
      min(l_quantity) / 2e0 - 5e0 as mintemperature,
      min(l_quantity) / 2e0 - 3e0 + max(l_discount) * 100e0 as maxtemperature,
      case when min(l_linenumber) <= 3 then 0e0 else max(l_quantity) / 5e0 end as precipitation,
      case when max(l_returnflag) = 'N' then null else min(l_tax) * 100e0 end as windspeed,
      cast(min(l_suppkey) % 360 as double) as winddirection,
      20e0 + min(l_discount) * 200e0 as minrelativehumidity, 60e0 + max(l_discount) * 300e0 as maxrelativehumidity,
      5e0 + max(l_tax) * 200e0 as radiation, max(l_discount) * 40e0 as pet
    from lineitem group by l_partkey, cast(l_shipdate as date))""",
    "v_icells": """
  select i.*, t.x, t.y, t.elevation, t.slope, t.aspect, t.tpi, t.partition
  from v_interp i join v_topo t on i.cell_id = t.cell_id""",
    "v_calib": """
  select dates as date_fin, day(dates) as day, month(dates) as month, year(dates) as year, i_step, n_stations, topo_ncells,
    cast(20 * (lines % 8) + 20 as double) as tmin_n, cast(20 * ((lines + 1) % 8) + 20 as double) as tmax_n,
    cast(20 * ((lines + 2) % 8) + 20 as double) as tdew_n, cast(20 * ((lines + 3) % 8) + 20 as double) as prec_event_n,
    cast(20 * ((lines + 4) % 8) + 20 as double) as prec_amount_n,
    cast(10 * (parts % 5) + 10 as double) as tmin_alpha, cast(10 * ((parts + 1) % 5) + 10 as double) as tmax_alpha,
    cast(10 * ((parts + 2) % 5) + 10 as double) as tdew_alpha, cast(10 * ((parts + 3) % 5) + 10 as double) as prec_event_alpha,
    cast(10 * ((parts + 4) % 5) + 10 as double) as prec_amount_alpha,
    disc * 10e0 + tax as tmin_mae, disc * 11e0 + tax as tmax_mae, disc * 12e0 + tax as tdew_mae,
    disc * 13e0 + tax as prec_event_mae, disc * 14e0 + tax as prec_amount_mae
  from (
    select cast(l_shipdate as date) as dates, cast(l_suppkey % 29 as int) as i_step, min(l_linenumber) as lines,
      max(l_partkey) as parts, max(l_discount) as disc, min(l_tax) as tax, count(distinct l_suppkey) as n_stations,
      count(*) as topo_ncells
    from lineitem group by cast(l_shipdate as date), cast(l_suppkey % 29 as int))""",
}

_NEEDS = {
    "v_obs": ("v_raw_obs", "v_stations"), "v_norm": ("v_obs",), "v_sums": ("v_obs",), "v_masked": ("v_norm", "v_sums"),
    "v_cells": ("v_grid",), "v_topo0": ("v_cells",), "v_topo": ("v_topo0",), "v_boxes": ("v_topo",),
    "v_member": ("v_stations", "v_boxes"), "v_placed": ("v_masked", "v_member"), "v_regions": ("v_centres",),
    "v_inside": ("v_cells", "v_centres"), "v_icells": ("v_interp", "v_topo"),
}


def with_views(*names: str, more: dict[str, str] | None = None) -> str:
    """A WITH clause of the named views and what they need, then further steps in order."""
    wanted: list[str] = []

    def visit(name):
        for need in _NEEDS.get(name, ()):
            visit(need)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        visit(name)
    steps = {n: VIEWS[n] for n in wanted} | (more or {})
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in steps.items()) + "\n"
