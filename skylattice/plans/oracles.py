"""For each registered query that SQL can express, the SQL for the oracle engine."""

from __future__ import annotations

from .fixtures import with_views as w

X, Y = "radians({0}lon)*6378137.0", "ln(tan(pi()/4+radians({0}lat)/2))*6378137.0"
N = f"n as (select id, name, lon, lat, {X.format('')} x, {Y.format('')} y from fx_nodes)"
O = f"o as (select *, {X.format('')} x, {Y.format('')} y from fx_obstacles)"  # noqa: E741
A = f"a as (select *, {X.format('')} x, {Y.format('')} y from fx_airports)"
D = "sqrt((n.x-{0}.x)*(n.x-{0}.x)+(n.y-{0}.y)*(n.y-{0}.y))"
C = "c as (select * from n where id % 10 <> 0)"
IN = "(case when r.min_lon <= r.max_lon then {0}lon >= r.min_lon and {0}lon <= r.max_lon else {0}lon >= r.min_lon or {0}lon <= r.max_lon end) and {0}lat between r.min_lat and r.max_lat"
MASK = f"m as (select n.id, cast(bit_or(cast(1 as bigint) << r.bit) as bigint) mask from fx_nodes n join fx_regions r on {IN.format('n.')} group by n.id)"
LOC = "l as (select f.way_id, f.pos, c.id node_id, c.lon, c.lat, c.x, c.y from fx_way_refs f join c on f.node_id = c.id)"
WM = f"wm as (select way_id, cast(bit_or(cast(1 as bigint) << r.bit) as bigint) mask from l join fx_regions r on {IN.format('l.')} group by way_id)"
EX = "ex as (select distinct l.way_id, l.node_id, wm.mask & ~coalesce(m.mask, 0) mask from l join wm using (way_id) left join m on m.id = l.node_id where wm.mask & ~coalesce(m.mask, 0) <> 0)"
CLOSED = """z as (select way_id, max(pos) last from fx_way_refs group by way_id),
    cr as (select way_id, pos, node_id from fx_way_refs union all
        select f.way_id, z.last + 1, f.node_id from fx_way_refs f join z using (way_id) where f.pos = 1 and f.way_id % 3 = 0 and z.last >= 3)"""
MADE = """g as (select cr.way_id, list(struct_pack(x := c.x, y := c.y) order by cr.pos) p from cr join c on cr.node_id = c.id group by cr.way_id having count(*) >= 2),
    made as (select way_id, p, len(p) >= 4 and p[1] = p[-1] closed from g)"""
SIGN = """(k = 'traffic_sign' or (k = 'highway' and v in ('stop','give_way','traffic_signals','milestone','crossing','turning_circle','turning_loop','motorway_junction','street_lamp','bus_stop'))
    or (k = 'barrier' and v in ('gate','bollard','kerb','lift_gate','block','cycle_barrier','swing_gate','stile')))"""
PLANT = "(k = 'natural' and v in ('tree','shrub','rock'))"
EXCL = "(k in ('source','created_by','attribution') or starts_with(k,'addr:') or starts_with(k,'building:') or starts_with(k,'source:') or starts_with(k,'tiger:'))"
TAGS = f"""t as (select f.*, exists(select 1 from fx_node_tags e where e.id = f.id and e.k in ('height','ele') and e.v <> '') high from fx_node_tags f),
    s as (select id, bool_or(not {EXCL} and (k <> 'building' or v in ('hangar','terminal','control_tower')) and not {SIGN} and (not {PLANT} or high) and k <> '' and v <> '') keep from t group by id)"""
LAST = "lc as (select * from (select *, row_number() over (partition by id order by seq desc, ord desc) rn from fx_changes) where rn = 1)"
TILES = """tl as (select n_nationkey tile_id, cast(n_nationkey*1439%340-170 as double) x0, cast(n_nationkey*37%140-60 as double) y0,
    list_transform(range(0,1600), lambda i: case when (i+n_nationkey)%7 <> 0 then (i*31+n_nationkey*17)%2000+0.5::double end) cells from nation)"""

ORACLES: dict[str, str] = {
    "mercator_points": f"{w('fx_nodes')}, {N} select id, round(x,3) x, round(y,3) y from n",
    "valid_lonlat_filter": f"{w('fx_nodes')} select id from fx_nodes where lon*1.02 between -180 and 180 and lat*1.1 between -90 and 90",
    "nearest_airport": f"""{w('fx_nodes','fx_airports')}, {N}, {A} select point_id, ident, type, elevation_ft, round(d/1000,3) dist_km from
        (select n.id point_id, ident, type, elevation_ft, {D.format('a')} d, row_number() over (partition by n.id order by {D.format('a')}, a.id) rn from n cross join a) where rn = 1""",
    "nearest_airports_3": f"""{w('fx_nodes','fx_airports')}, {N}, {A} select point_id, cast(rn as int) as rank, ident, round(d,3) dist_m from
        (select n.id point_id, ident, {D.format('a')} d, row_number() over (partition by n.id order by {D.format('a')}, a.id) rn from n cross join a) where rn <= 3""",
    "obstacles_nearby": f"""{w('fx_nodes','fx_obstacles')}, {N}, {O} select n.id point_id, o.id, obstacle_type, agl_ht, round({D.format('o')},3) dist_m
        from n join o on abs(n.x-o.x) <= 100000 and {D.format('o')} <= 100000""",
    "obstacle_radius_stats": f"""{w('fx_nodes','fx_obstacles')}, {N}, {O} select n.id point_id, count(*) n, max(amsl_ht) max_amsl, max(agl_ht) max_agl
        from n join o on abs(n.x-o.x) <= 200000 and {D.format('o')} <= 200000 group by n.id""",
    "routes_nearby": f"""{w('fx_nodes','fx_route_points')}, {N}, p as (select route_id, pos, {X.format('')} x, {Y.format('')} y from fx_route_points),
        s as (select a.route_id, a.x ax, a.y ay, b.x bx, b.y b_y, (b.x-a.x)*(b.x-a.x)+(b.y-a.y)*(b.y-a.y) l2 from p a join p b on a.route_id = b.route_id and b.pos = a.pos + 1),
        q as (select n.id, n.x, n.y, s.*, case when l2 > 0 then least(1.0, greatest(0.0, ((n.x-ax)*(bx-ax)+(n.y-ay)*(b_y-ay))/l2)) else 0.0 end t from n cross join s),
        d as (select id, route_id, min(sqrt((x-(ax+t*(bx-ax)))*(x-(ax+t*(bx-ax)))+(y-(ay+t*(b_y-ay)))*(y-(ay+t*(b_y-ay))))) dist from q group by id, route_id)
        select id point_id, route_id id, round(dist,3) dist_m from d where dist <= 200000""",
    "airspace_at_point": f"""{w('fx_nodes','fx_airspace')} select n.id point_id, case when a.id%2=0 then 'OPENAIP' else 'FAA_CLASS' end source,
        case when a.id%2=1 then 'C' when icao_class between 0 and 6 then substr('ABCDEFG', cast(icao_class+1 as int), 1) end as class,
        case when a.id%2=0 then '7' else 'CLASS_C' end as type, a.name, case when a.id%2=0 then a.id*100.0::double end lower_val
        from fx_nodes n join fx_airspace a on n.lon > min_lon and n.lon < max_lon and n.lat > greatest(-85.0, min_lat) and n.lat < least(85.0, max_lat)""",
    "icao_class_decode": f"{w('fx_airspace')} select id, case when icao_class between 0 and 6 then substr('ABCDEFG', cast(icao_class+1 as int), 1) end as class from fx_airspace",
    "great_circle_km": f"""{w('fx_airports')} select a.id, round(asin(sqrt(least(1.0, pow(sin(radians(b.lat-a.lat)/2),2)+cos(radians(a.lat))*cos(radians(b.lat))*pow(sin(radians(b.lon-a.lon)/2),2))))*2*6371008.8/1000,3) km
        from fx_airports a join fx_airports b on b.id = a.id + 1""",
    "tag_survival": f"{w('fx_node_tags')}, {TAGS} select id, keep survives from s",
    "tag_rows": f"{w('fx_node_tags')}, {TAGS} select t.id, k key_name, v key_value from t join s using (id) where keep and not {EXCL} and not {SIGN} and (not {PLANT} or high) and k <> '' and v <> ''",
    "node_clutter_filter": f"{w('fx_node_tags')} select id, k, v from fx_node_tags where {SIGN} or {PLANT}",
    "is_area_classify": f"""{w('fx_way_tags')}, g as (select id, max(case when k='area' then v end) area,
        bool_or(k in ('highway','railway','waterway','power','man_made') or (k='junction' and v in ('roundabout','circular')) or (k='barrier' and v in ('fence','wall','hedge','retaining_wall','city_wall')) or (k='aeroway' and v in ('runway','taxiway','taxilane'))) linear,
        bool_or(k in ('building','building:part','landuse','leisure','natural','amenity','shop','tourism','historic','military','boundary','place','sport','landcover')) areal from fx_way_tags group by id)
        select id, case when id%3<>0 then false when area='yes' then true when area='no' then false when linear then false else areal end area from g""",
    "road_promotion": f"{w('fx_way_tags')} select distinct id from fx_way_tags where (k='route' and v='road') or k='highway'",
    "multipolygon_flag": f"{w('fx_way_tags')} select distinct id from fx_way_tags where k='type' and v in ('multipolygon','boundary')",
    "tag_text_clean": f"{w('fx_node_tags')} select id, k, left(repeat(k,60),256) cleaned, cast(length(left(repeat(k,60),256)) as int) n from fx_node_tags",
    "way_vertices": f"{w('fx_nodes','fx_way_refs')}, {N}, {C} select f.way_id, f.pos, round(c.x,3) x, round(c.y,3) y from fx_way_refs f join c on f.node_id = c.id",
    "way_closed_flag": f"{w('fx_nodes','fx_way_refs')}, {N}, {C}, {CLOSED}, {MADE} select way_id, cast(len(p) as int) n, closed from made",
    "relation_members": f"""{w('fx_nodes','fx_way_refs','fx_rel_members')}, {N}, {C}, g as (select f.way_id, count(*) n from fx_way_refs f join c on f.node_id = c.id group by f.way_id having count(*) >= 2)
        select rel_id, pos, way_id, role, cast(n as int) n from fx_rel_members join g using (way_id)""",
    "relation_lines": f"""{w('fx_nodes','fx_way_refs','fx_rel_members')}, {N}, {C}, {CLOSED}, {MADE}
        select rel_id, cast(count(*) as int) n_lines, cast(sum(len(p)) as int) n_points, round(arg_min(p[1].x, pos),3) first_x from fx_rel_members join made using (way_id) where not closed group by rel_id""",
    "union_ways_areas": f"""{w('fx_nodes','fx_way_refs')}, {N}, {C}, {CLOSED}, {MADE}
        select way_id id, cast(case when not closed or way_id%2=0 then len(p) else 3 end as int) n from made""",
    "region_mask": f"{w('fx_nodes','fx_regions')}, {MASK} select id, mask from m",
    "region_row_counts": f"{w('fx_nodes','fx_regions')} select r.name region, count(*) n from fx_nodes n join fx_regions r on {IN.format('n.')} group by r.name",
    "child_tags_by_region": f"{w('fx_nodes','fx_regions','fx_node_tags')}, {MASK} select id, k, v, mask from fx_node_tags join m using (id)",
    "way_region_mask": f"{w('fx_nodes','fx_regions','fx_way_refs')}, {N}, {C}, {LOC}, {WM} select way_id, mask from wm",
    "extra_vertices": f"{w('fx_nodes','fx_regions','fx_way_refs')}, {N}, {C}, {LOC}, {WM}, {MASK}, {EX} select way_id, node_id, mask from ex",
    "coord_exact_join": f"""{w('fx_nodes','fx_regions','fx_way_refs')}, {N}, {C}, {LOC}, {WM}, {MASK}, {EX}, v as (select c.lon, c.lat, bit_or(ex.mask) mask from ex join c on c.id = ex.node_id group by c.lon, c.lat)
        select n.id, v.mask from n join v on n.lon = v.lon and n.lat = v.lat""",
    "manifest_counts": f"""{w('fx_nodes','fx_regions','fx_node_tags')} select r.name region, 'nodes' as table, count(*) n from fx_nodes n join fx_regions r on {IN.format('n.')} group by r.name
        union all select r.name, 'node_tags', count(*) from fx_nodes n join fx_regions r on {IN.format('n.')} join fx_node_tags t on t.id = n.id group by r.name""",
    "installed_bbox": f"{w('fx_regions')} select min(min_lon) min_lon, min(min_lat) min_lat, max(max_lon) max_lon, max(max_lat) max_lat from fx_regions",
    "node_store_merge": f"""{w('fx_nodes')} select id, case when id%3<>0 then lon else lon+1 end x, lat y from fx_nodes where id%3<>0 or id%2=0""",
    "store_resolve_tiers": f"""{w('fx_nodes','fx_way_refs')} select way_id, pos, node_id, case when n.id%7=0 then lon+2 when n.id%5=0 then lon+1 else lon end x
        from fx_way_refs f join fx_nodes n on n.id = f.node_id where n.id%7=0 or n.id%5=0 or n.id%10<>3""",
    "store_update": f"""{w('fx_nodes')}, mv as (select id*100000000 id, lon+1 x, lat y from fx_nodes where id%11=0 and id*100000000 <= 100000000000 union all select id, lon+5, lat from fx_nodes where id%13=0),
        u as (select 0 p, * from mv union all select 1, id, lon, lat from fx_nodes where id%17<>0)
        select id, x, y from (select *, row_number() over (partition by id order by p, x, y) rn from u) where rn = 1""",
    "highest_populated_id": f"{w('fx_nodes')} select max(id) highest, min(id) lowest, count(*) n from fx_nodes where id%10<>0",
    "id_window": f"{w('fx_nodes')} select id, lon from fx_nodes where id between 100 and 899",
    "insert_if_absent": f"{w('fx_nodes')} select id, lon from fx_nodes where id%2=0 and id%3<>0",
    "child_semi_insert": f"{w('fx_nodes','fx_node_tags')} select id, k, v from fx_node_tags where id in (select id from fx_nodes where id%2=0 and id%3<>0)",
    "orphan_tags": f"{w('fx_nodes','fx_node_tags')} select k, count(*) n from fx_node_tags t where not exists (select 1 from fx_nodes n where n.id = t.id and n.id%10<>0) group by k",
    "changes_collapse": f"{w('fx_changes')}, {LAST} select id, seq, ord, op, value from lc",
    "upsert_result": f"{w('fx_changes')}, {LAST} select c_custkey id, c_acctbal as value from customer where c_custkey not in (select id from lc) union all select id, value from lc where op <> 'delete'",
    "tag_diff_ops": f"""{w('fx_node_tags')}, a as (select * from fx_node_tags where id%4<>0), b as (select id, k, case when id%5=0 then v||'!' else v end v from fx_node_tags where id%6<>0)
        select id, k, case when a.v is null then 'insert' when b.v is null then 'delete' else 'update' end op, a.v old_v, b.v new_v from a full join b using (id, k) where a.v is distinct from b.v""",
    "delete_cascade": f"{w('fx_node_tags','fx_changes')}, {LAST} select k, count(*) n from fx_node_tags where id not in (select id from lc where op='delete') group by k",
    "change_counts": f"{w('fx_changes')} select op, count(*) n from fx_changes group by op",
    "airport_fk_joins": "select l_suppkey+l_linenumber*20 airport_ref, count(*) n, sum(l_quantity) length from lineitem where l_suppkey+l_linenumber*20 in (select s_suppkey from supplier) group by 1",
    "csv_numeric_coercion": """with r as (select p_partkey, p_size, ([' ','-','','x'])[p_partkey%4+1] || p_size || (['abc','.25',''])[p_partkey%3+1] s from part)
        select p_partkey, try_cast(regexp_extract(s, '^[ \\t]*([+-]?[0-9]+)', 1) as int) i, try_cast(regexp_extract(s, '^[ \\t]*([+-]?[0-9]+\\.?[0-9]*)', 1) as double) d, p_size = 1 b from r""",
    "json_limit_extract": """select event_id, try_cast(regexp_extract(props, '(\\d+)', 1) as double) as value, try_cast(regexp_extract(props, '(\\d+)', 1) as int) unit, cast(null as int) upper from events""",
    "accuracy_split": """with r as (select p_partkey, p_type, case when p_size%5=0 then '' when p_size%5=1 then substr(p_brand,1,1) else substr(p_brand,1,2) end c from part)
        select p_partkey, substr(c,1,1) horizontal, substr(c,2,1) vertical, substr(p_type,1,1)='O' verified from r""",
    "seq_to_path": "select p_partkey, printf('%03d/%03d/%03d', p_partkey*12347//1000000, p_partkey*12347//1000%1000, p_partkey*12347%1000) path from part",
    "sequence_estimate": "select o_orderkey, greatest(cast(0 as bigint), 6500000 - cast(floor(greatest(0, 1000000000 - epoch(o_orderdate) + 259200)/60) as bigint)) seq from orders",
    "tile_names": f"""{w('fx_nodes')}, f as (select id, cast(floor(lat) as int) la, cast(floor(lon) as int) lo, cast(floor(floor(lat)/10)*10 as int) la10, cast(floor(floor(lon)/10)*10 as int) lo10 from fx_nodes)
        select id, printf('%s%02d_00_%s%03d_00', case when la>=0 then 'N' else 'S' end, abs(la), case when lo>=0 then 'E' else 'W' end, abs(lo)) dem,
            printf('%s%02d%s%03d', case when la10>=0 then 'N' else 'S' end, abs(la10), case when lo10>=0 then 'E' else 'W' end, abs(lo10)) as cell from f""",
    "tiles_missing": f"""{w('fx_nodes','fx_regions')}, la as (select unnest(range(-60,75)) lat), lo as (select unnest(range(-180,180)) lon),
        t as (select r.name, lat, lon from fx_regions r cross join la cross join lo where case when min_lon<=max_lon then lon>=floor(min_lon) and lon<ceil(max_lon) else lon>=floor(min_lon) or lon<ceil(max_lon) end)
        select name, count(*) n from t where not exists (select 1 from fx_nodes n where floor(n.lat)=t.lat and floor(n.lon)=t.lon) group by name""",
    "raster_point_value": f"""{w('fx_nodes')}, {TILES}, h as (select n.id, tile_id, cells[cast(floor((y0-lat)/0.25)*40+floor((lon-x0)/0.25) as int)+1] v from fx_nodes n join tl
            on floor((lon-x0)/0.25) between 0 and 39 and floor((y0-lat)/0.25) between 0 and 39)
        select id point_id, round(arg_min(v, tile_id)*3.28084,3) elevation_ft from h where v is not null group by id""",
    "raster_summary": f"with {TILES}, u as (select unnest(cells) v from tl) select cast(min(v) as double) lo, cast(max(v) as double) hi, cast(count(v) as bigint) n from u",
    "declination_band_id": f"{w('fx_changes')} select seq, ord, cast(ceil((value/10-floor(-3.3::double/0.25)*0.25)/0.25) as int) band from fx_changes",
    "band_cells": f"""with {TILES}, u as (select tile_id, x0, y0, unnest(range(0,1600)) i, unnest(cells) v from tl),
        b as (select cast(ceil((v-floor((select min(v) from u)/100.0)*100.0)/100.0) as int) band, floor((x0+(i%40+0.5)*0.25)/10) bx, floor((y0-(i//40+0.5)*0.25)/10) b_y from u where v is not null)
        select band, cast(count(*) as bigint) n_cells, count(distinct (bx, b_y)) n_buckets from b group by band""",
    "elevation_profile_steps": "select p_partkey, cast(unnest(range(0, p_size*37+1, 500)) as int) distance_m from part",
    "angle_diff_stats": f"{w('fx_changes')}, d as (select abs(value*3-id)-360*floor(abs(value*3-id)/360) a from fx_changes) select round(avg(least(a,360-a)),6) mean, round(max(least(a,360-a)),6) most, count(*) n from d",
    "rough_region_counts": f"""{w('fx_nodes')} select case when lat>7 and lon between -170 and -50 then 'North America' when lat<=7 and lon<=-34 then 'South America' when lat between -35 and 37 and lon between -20 and 52 then 'Africa'
        when lat between 35 and 72 and lon between -25 and 45 then 'Europe' when lon>45 or lon<-170 then 'Asia/Oceania' else 'Other' end region, count(*) n from fx_nodes group by 1""",
    "names_top3": f"""{w('fx_nodes','fx_obstacles')}, {N}, {O}, p as (select n.id point_id, obstacle_type as name, count(*) n from n join o on abs(n.x-o.x) <= 500000 and {D.format('o')} <= 500000 group by 1, 2)
        select point_id, name, n, cast(total as bigint) total, cast(rn as int) as rank from (select *, sum(n) over (partition by point_id) total, row_number() over (partition by point_id order by n desc, name) rn from p) where rn <= 3""",
    "row_count_bounds": f"""{w('fx_node_tags')} select 'orders' as table, count(*) n, count(*) between 1 and 1000000000 ok from orders union all select 'customer', count(*), count(*) between 10000000 and 1000000000 from customer
        union all select 'fx_node_tags', count(*), count(*) between 100 and 10000000 from fx_node_tags""",
    "staleness_flags": """with s as (select event_type as name, date_trunc('second', max(ts)) c from events group by 1), h as (select name, (epoch(timestamp '2024-06-01') - epoch(c))/3600.0::double hh from s)
        select name, round(hh,3) "hours", case when name='click' then hh>24 when name='error' then hh>1000000 else true end stale from h""",
    "refresh_due": """with s as (select event_type as name, min(floor(epoch(ts))) v from events where event_type<>'view' group by 1), r as (select event_type as name, max(floor(epoch(ts))) m from events group by 1)
        select name, coalesce(case when name='signup' then epoch(timestamp '2024-06-01')-v >= 90*86400 when name='error' then epoch(timestamp '2024-06-01')-v >= 100000*86400::bigint end, abs(m-v)>300, true) due from r left join s using (name)""",
    "report_row_sample": """with r as (select p_partkey idx, case when p_partkey%50=0 then 'airport' else 'random' end kind, cast(case when p_size>48 then 3 when p_size>45 then 1 else 0 end as int) flags from part),
        c as (select count(*) filter (kind<>'random') nf, count(*) filter (kind='random') nr, count(*) filter (kind='random' and flags>0) ng from r),
        q as (select r.*, row_number() over (partition by flags>0 order by flags desc, idx)-1 k, greatest(0,500-nf) b, least(ng, greatest(0,500-nf)) sf, nf, nr, ng from r cross join c where kind='random'),
        z as (select *, b-sf l, greatest(1, (nr-ng)//greatest(b-sf,1)) st from q)
        select idx, kind, flags from r where kind<>'random' union all select idx, kind, flags from z where nf+nr<=500 or b>=nr or (flags>0 and k<sf) or (flags<=0 and l>0 and k%st=0 and k//st<l)""",
    "golden_facts": """with m as (select s_nationkey, sum(s_nationkey) v from supplier group by 1) select n_name as key, coalesce(abs(v-n_nationkey*10.0) <= 40, false) ok, round(abs(v-n_nationkey*10.0)::double,6) diff
        from nation left join m on s_nationkey = n_nationkey""",
    "quarantine_rows": f"""{w('fx_nodes')} select id, case when abs(lon*1.02) > 180 then 'longitude' when abs(lat*1.1) > 90 then 'latitude' else 'id' end reason from fx_nodes
        where abs(lon*1.02) > 180 or abs(lat*1.1) > 90 or id%97=0""",
    "region_sample_check": f"{w('fx_nodes','fx_regions')} select r.name region, count(*) n, cast(0 as bigint) outside from fx_nodes n join fx_regions r on {IN.format('n.')} group by r.name",
    "nodes_near_airports": f"""{w('fx_nodes','fx_airports')}, {N}, {A} select point_id, cast(rn as int) as rank, id, round(d,3) dist_m from
        (select a.id point_id, n.id, {D.format('a')} d, row_number() over (partition by a.id order by {D.format('a')}, n.id) rn from n join a on {D.format('a')} <= 500000) where rn <= 5""",
    "loaded_cells": f"""{w('fx_regions')}, la as (select unnest(range(-60,80,10)) lat), lo as (select unnest(range(-180,180,10)) lon),
        t as (select r.name, lat, lon from fx_regions r cross join la cross join lo where case when min_lon<=max_lon then lon>=floor(min_lon/10)*10 and lon<ceil(max_lon/10)*10 else lon>=floor(min_lon/10)*10 or lon<ceil(max_lon/10)*10 end)
        select name, count(*) n from t where not exists (select 1 from nation where n_nationkey%12*10-60=lat and n_nationkey*10-120=lon) group by name""",
    "timing_by_category": "select event_type, count(*) n, round(avg(value),6) avg_ms, round(sum(value)/1000,6) total_s from events group by 1",
    "model_difference": "select round(avg(abs(s_acctbal-s_suppkey*10)),6) mean, round(max(abs(s_acctbal-s_suppkey*10)),6) most, count(*) filter (abs(s_acctbal-s_suppkey*10)>500) outliers from supplier",
}
