"""ANSI SQL counterparts of the registered queries, over the same Parquet tables.

Written from the definitions of the figures, independently of the Spark code: means over
joined rows are plain averages over a plain join, roll-ups go through the monthly table.
"""

from __future__ import annotations

from facilitymetrics.operators.joins import STATE_NAMES

_CODES = ", ".join(f"'{code}'" for code in STATE_NAMES)
_STATES = ", ".join(f"('{code}', '{name}')" for code, name in STATE_NAMES.items())


def _state(key: str) -> str:
    return f"([{_CODES}])[{key} % {len(STATE_NAMES) + 1} + 1]"


def _name(key: str) -> str:
    return f"'FACILITY ' || cast({key} // 3 as varchar)"


_QUARTER = "year(l_shipdate) || 'Q' || quarter(l_shipdate)"

_PROVIDER = f"""
provider_base as (
  select case when p_size <> 13 then cast(p_partkey as varchar) end as ccn,
         {_name('p_partkey')} as provider_name,
         {_state('p_partkey')} as state,
         p_type as ownership_type,
         p_brand as provider_type,
         p_name as provider_address,
         '0' || p_size as zip_code,
         p_size - 1 as certified_beds,
         case when p_size = 50 then 0.0
              else cast(floor(p_retailprice) as double) / 32 end as average_residents_per_day,
         case when p_size % 6 <> 0 then p_size % 6 end as overall_rating,
         case when p_size % 7 <= 5 then p_size % 7 end as staffing_rating,
         p_size % 5 + 1 as qm_rating,
         p_size % 4 + 1 as long_stay_qm_rating,
         p_size % 3 + 1 as short_stay_qm_rating,
         cast(p_size as double) / 64 as total_nursing_staff_turnover,
         case when p_size % 10 <> 0
              then cast(p_size as double) / 128 end as registered_nurse_turnover,
         p_size % 2 as number_of_administrators_who_left_the_nursing_home
  from part),
provider as (
  select *, cast(average_residents_per_day as double) / nullif(certified_beds, 0)
              as occupancy_rate
  from provider_base)"""

_PBJ = f"""
pbj_base as (
  select case when l_quantity <> 50 then cast(l_partkey as varchar) end as ccn,
         case when l_linenumber <> 7 then {_name('l_partkey')} end as provider_name,
         case when l_discount <> 0.01 then {_state('l_partkey')} end as state,
         case when l_linenumber = 6 then null when l_tax = 0.08 then 20241399
              else cast(strftime(l_shipdate, '%Y%m%d') as integer) end as workdate,
         {_QUARTER} as cy_qtr,
         case when l_linenumber <> 6 and l_tax <> 0.08
              then strftime(l_shipdate, '%Y-%m') end as month,
         case when l_linenumber <> 6 and l_tax <> 0.08 then cast(l_shipdate as date) end as work_day,
         (l_quantity - 1) / 4 as rn,
         case when l_linenumber <> 3 then round(l_discount * 100) / 4 end as lpn,
         round(l_tax * 100) / 4 as cna,
         case when l_linestatus = 'F' then cast(1 as double) else cast(0 as double) end
           as natrn_emp,
         cast(l_linenumber as double) / 2 as medaide_emp,
         case when l_returnflag <> 'R' then cast(0.5 as double) end as lpn_ctr,
         cast(0 as double) as natrn_ctr,
         cast(0.25 as double) as medaide_ctr,
         l_linestatus
  from lineitem),
pbj as (
  select *, rn + lpn + cna as total_hrs,
         rn * 0.75::double + lpn + cna * 0.5::double as emp_nurse_hrs,
         rn * 0.75::double + lpn + cna * 0.5::double + natrn_emp + medaide_emp as employee_hrs,
         rn * 0.25::double + lpn_ctr + cna * 0.5::double + natrn_ctr + medaide_ctr
           as contractor_hrs
  from pbj_base)"""

_QUALITY = f"""
quality_base as (
  select cast(l_partkey as varchar) as cms_certification_number_ccn,
         {_name('l_partkey')} as provider_name,
         'SUITE ' || l_suppkey as provider_address,
         '0' || l_suppkey as zip_code,
         'M' || l_linenumber as measure_code,
         'Measure ' || l_linenumber as measure_description,
         l_returnflag as resident_type,
         {_QUARTER} as measure_period,
         case when l_discount <> 0 then l_discount end as q1_measure_score,
         case when l_tax <> 0 then l_tax end as q2_measure_score,
         case when l_returnflag = 'A' then l_quantity end as q3_measure_score,
         case when l_linestatus = 'F' then cast(l_linenumber as double) end
           as q4_measure_score,
         l_extendedprice as four_quarter_average_score,
         strftime(l_shipdate, '%Y-%m-%d') as processing_date
  from lineitem)"""

_QUALITY_DERIVED = """
         cast((q1_measure_score is null)::int + (q2_measure_score is null)::int
              + (q3_measure_score is null)::int + (q4_measure_score is null)::int as integer)
           as missing_quarter_count,
         coalesce(q1_measure_score, 0) + coalesce(q2_measure_score, 0)
           + coalesce(q3_measure_score, 0) + coalesce(q4_measure_score, 0)
           as sum_of_available_quarterly_scores,
         greatest(q1_measure_score, q2_measure_score, q3_measure_score, q4_measure_score)
           as max_quarterly_measure_score,
         least(q1_measure_score, q2_measure_score, q3_measure_score, q4_measure_score)
           as min_quarterly_measure_score,
         greatest(q1_measure_score, q2_measure_score, q3_measure_score, q4_measure_score)
           - least(q1_measure_score, q2_measure_score, q3_measure_score, q4_measure_score)
           as quarterly_score_range"""

_AVERAGES = """
averages as (
  select n_name as state,
         case when s_suppkey % 7 <> 0 then s_acctbal end as c1,
         case when s_suppkey % 3 <> 0 then cast(s_nationkey as double) end as c2,
         case when s_suppkey % 5 <> 0 then s_acctbal / 2 end as c3,
         '2024-10-01' as processing_date
  from supplier join nation on s_nationkey = n_nationkey)"""

_AVERAGES_RENAMED = """
  state, processing_date,
  c1 as cycle_1_total_number_of_health_deficiencies,
  c2 as cycle_2_total_number_of_health_deficiencies,
  c3 as cycle_3_total_number_of_health_deficiencies"""

_AVERAGES_DERIVED = """
  coalesce(c1, 0) + coalesce(c2, 0) + coalesce(c3, 0) as all_cycle_total_health_deficiencies,
  greatest(c1, c2, c3) - least(c1, c2, c3) as total_health_deficiencies_range"""

_PROVIDER_COLUMNS = """
  ccn as cms_certification_number_ccn, provider_name, state, ownership_type, provider_type,
  provider_address, zip_code, certified_beds,
  cast(average_residents_per_day as double) as average_residents_per_day, overall_rating,
  staffing_rating, qm_rating, long_stay_qm_rating, short_stay_qm_rating,
  total_nursing_staff_turnover, registered_nurse_turnover,
  number_of_administrators_who_left_the_nursing_home"""

_PBJ_COLUMNS = """
  ccn as cms_certification_number_ccn, provider_name, state, workdate as "WorkDate",
  cy_qtr as "CY_Qtr", rn as "Hrs_RN", lpn as "Hrs_LPN", cna as "Hrs_CNA",
  rn * 0.75::double as "Hrs_RN_emp", lpn as "Hrs_LPN_emp", cna * 0.5::double as "Hrs_CNA_emp",
  natrn_emp as "Hrs_NAtrn_emp", medaide_emp as "Hrs_MedAide_emp",
  rn * 0.25::double as "Hrs_RN_ctr", lpn_ctr as "Hrs_LPN_ctr", cna * 0.5::double as "Hrs_CNA_ctr",
  natrn_ctr as "Hrs_NAtrn_ctr", medaide_ctr as "Hrs_MedAide_ctr", l_linestatus"""

_PBJ_DERIVED = """
  total_hrs as "Total_Nurse_Hrs", rn / nullif(total_hrs, 0) as "RN_Percentage",
  emp_nurse_hrs as "Total_emp_Nurse_Hrs",
  rn * 0.75::double / nullif(emp_nurse_hrs, 0) as "Emp_Nurse_Percentage",
  employee_hrs, contractor_hrs"""

_MONTHS = """
months as (
  select ccn, provider_name, state, month, coalesce(sum(total_hrs), 0) as hours
  from pbj
  where ccn is not null and provider_name is not null and state is not null
    and month is not null
  group by ccn, provider_name, state, month)"""

_WITH_PROVIDER = f"with {_PROVIDER}"
_WITH_PBJ = f"with {_PBJ}"
_WITH_BOTH = f"with {_PROVIDER}, {_PBJ}"


def _selected(choice: str = "true") -> str:
    """CTEs: selected facilities, their staffing rows, facility means, joined rows."""
    return f"""{_WITH_BOTH},
facilities as (select * from provider where {choice}),
days as (
  select * from pbj
  where exists (select 1 from facilities f where f.ccn is not distinct from pbj.ccn)),
means2 as (
  select ccn, provider_name, avg(total_hrs) as avg_total_nurse_hrs from days
  where ccn is not null and provider_name is not null group by ccn, provider_name),
means3 as (
  select ccn, provider_name, state, avg(total_hrs) as avg_total_nurse_hrs from days
  where ccn is not null and provider_name is not null and state is not null
  group by ccn, provider_name, state),
joined as (
  select f.*, m.avg_total_nurse_hrs,
         m.avg_total_nurse_hrs / nullif(f.average_residents_per_day, 0)
           as nurse_hours_per_resident
  from facilities f join means2 m on f.ccn = m.ccn and f.provider_name = m.provider_name)"""


def _occupancy_kpis(choice: str) -> str:
    def mean(column: str, name: str) -> str:
        return (
            f"round(case when count(*) = 0 then 0.0::double else avg({column}) end, 6) as {name}"
        )

    return f"""{_WITH_PROVIDER}
select count(distinct provider_name) as providers,
       {mean('occupancy_rate', 'avg_occupancy')},
       {mean('certified_beds', 'avg_certified_beds')},
       {mean('average_residents_per_day', 'avg_residents')}
from provider where {choice}"""


def _kpi_parts(choice: str) -> str:
    return f"""{_selected(choice)},
counted as (select count(distinct provider_name) as providers from facilities),
averaged as (
  select coalesce(avg(avg_total_nurse_hrs), 0) as avg_nurse_hours,
         coalesce(avg(nurse_hours_per_resident), 0) as avg_nurse_hours_per_resident,
         coalesce(avg(occupancy_rate), 0) as avg_occupancy
  from joined),
totals as (
  select coalesce(sum(employee_hrs), 0) as e, coalesce(sum(contractor_hrs), 0) as c
  from days)"""


def _staffing_kpis(choice: str) -> str:
    return f"""{_kpi_parts(choice)}
select providers, round(avg_nurse_hours, 6) as avg_nurse_hours,
       round(avg_nurse_hours_per_resident, 6) as avg_nurse_hours_per_resident,
       round(avg_occupancy, 6) as avg_occupancy,
       e as total_employee_hrs, c as total_contractor_hrs, e + c as total_nursing_hrs,
       case when e = 0 and c = 0 then null else c / nullif(e + c, 0) end
         as contractor_hours_pct,
       case when c > 0 then e / c end as employee_contractor_ratio,
       case when e + c > 0 then e / (e + c) else 0 end as employee_pct,
       case when e + c > 0 then c / (e + c) else 0 end as contractor_pct
from counted, averaged, totals"""


def _analysis(choice: str) -> str:
    return f"""{_selected(choice)}
select ccn as cms_certification_number_ccn, provider_name, state, ownership_type,
       occupancy_rate, average_residents_per_day, avg_total_nurse_hrs,
       nurse_hours_per_resident
from joined"""


def _hours_per_resident(choice: str) -> str:
    return f"""{_selected(choice)}
select state, round(avg(nurse_hours_per_resident), 6) as nurse_hours_per_resident
from joined where state is not null group by state"""


def _facility_staffing(choice: str, keys: int) -> str:
    state = ", state" if keys == 3 else ""
    return f"""{_selected(choice)}
select ccn as cms_certification_number_ccn, provider_name{state}, avg_total_nurse_hrs
from means{keys}"""


def _stars(rating: str) -> str:
    return (
        f"case when {rating} is null then 'Not rated' else repeat('★', {rating}) "
        f"|| repeat('☆', 5 - {rating}) || ' (' || {rating} || '/5)' end"
    )


def _percent(value: str, decimals: int = 1) -> str:
    return f"format('{{:.{decimals}f}}', {value} * 100) || '%'"


def _provider_detail(choice: str) -> str:
    return f"""{_WITH_PROVIDER},
first as (
  select * from provider where {choice}
  order by ccn nulls last, provider_name nulls last, state nulls last,
           ownership_type nulls last, occupancy_rate nulls last, overall_rating nulls last,
           staffing_rating nulls last
  limit 1),
states(code, label) as (values {_STATES})
select provider_name, coalesce(label, state) as state_name, ownership_type,
       {_percent('occupancy_rate', 2)} as occupancy,
       {_stars('overall_rating')} as overall_rating,
       {_stars('staffing_rating')} as staffing_rating
from first left join states on state = code"""


def _options(column: str, choice: str = "true") -> str:
    return f"""{_WITH_PROVIDER}
select distinct {column} from provider where {column} is not null and {choice}
order by {column}"""


def _scope(choice: str) -> str:
    return f"""{_WITH_PROVIDER}
select ccn as cms_certification_number_ccn, provider_name, state, ownership_type,
       occupancy_rate
from provider where {choice}"""


def _group_mean(column: str) -> str:
    return f"""{_WITH_PROVIDER}
select provider_name, round(avg({column}), 6) as {column}
from provider where provider_name is not null group by provider_name"""


_AUDIT = [
    ("CMS Certification Number (CCN)", "string"),
    ("Provider Name", "string"),
    ("State", "string"),
    ("Ownership Type", "string"),
    ("Provider Type", "string"),
    ("Provider Address", "string"),
    ("Zip Code", "string"),
    ("Number of Certified Beds", "int"),
    ("Long-Stay QM Rating", "int"),
    ("Short-Stay QM Rating", "int"),
    ("QM Rating", "int"),
    ("Overall Rating", "int"),
    ("Staffing Rating", "int"),
    ("Number of administrators who have left the nursing home", "int"),
    ("Average Number of Residents per Day", "double"),
    ("Total nursing staff turnover", "double"),
    ("Registered nurse turnover", "double"),
]


def statements(state: str, owner: str, provider: str) -> dict[str, str]:
    in_state = f"state = '{state}'"
    of_owner = f"ownership_type = '{owner}'"
    of_provider = f"provider_name = '{provider}'"
    nothing = "state = 'ZZ'"
    audit = ", ".join(f"('{name}', '{kind}', '{kind}', 'ok')" for name, kind in _AUDIT)
    curated_provider = f"""{_WITH_PROVIDER}
select distinct {_PROVIDER_COLUMNS}, occupancy_rate from provider"""
    summary = f"""{_WITH_PBJ}
select ccn as cms_certification_number_ccn, provider_name, state, cy_qtr as "CY_Qtr",
       month || '-01' as month, sum(total_hrs) as "Total_Nurse_Hrs",
       count(total_hrs) as hour_days, count(*) as record_count,
       sum(employee_hrs) as employee_hrs, sum(contractor_hrs) as contractor_hrs
from pbj group by ccn, provider_name, state, cy_qtr, month"""
    curated_quality = f"""with {_QUALITY}
select distinct *, {_QUALITY_DERIVED} from quality_base"""
    return {
        "csv_roundtrip": f"""with {_AVERAGES}
select distinct {_AVERAGES_RENAMED.replace('state,', 'state as state_or_nation,', 1)}
from averages""",
        "parquet_overwrite_roundtrip": curated_provider,
        "parquet_partitioned_roundtrip": curated_quality,
        "row_count_audit": "select count(*) as row_count from lineitem",
        "schema_audit": f"""
select column_name, declared_type, actual_type, status, row_count
from (values {audit}) as findings(column_name, declared_type, actual_type, status),
     (select count(*) as row_count from part) as counted""",
        "undated_rows": """
select count(*) as row_count,
       count(*) filter (where l_linenumber = 6 or l_tax = 0.08) as undated_rows from lineitem""",
        "rename_pbj": f"{_WITH_PBJ} select {_PBJ_COLUMNS} from pbj",
        "rename_provider_info": f"{_WITH_PROVIDER} select {_PROVIDER_COLUMNS} from provider",
        "rename_quality": f"with {_QUALITY} select * from quality_base",
        "rename_state_averages": f"with {_AVERAGES} select {_AVERAGES_RENAMED} from averages",
        "dedup_full_row": """
select distinct * replace (strftime(l_shipdate, '%Y-%m-%d') as l_shipdate) from lineitem""",
        "nurse_hours_strict": f"""{_WITH_PBJ}
select ccn as cms_certification_number_ccn, workdate as "WorkDate", {_PBJ_DERIVED} from pbj""",
        "occupancy_rate": f"""{_WITH_PROVIDER}
select ccn as cms_certification_number_ccn, provider_name, occupancy_rate from provider""",
        "quarterly_scores": f"""with {_QUALITY}
select cms_certification_number_ccn, measure_code, {_QUALITY_DERIVED} from quality_base""",
        "deficiency_cycles": f"with {_AVERAGES} select state, {_AVERAGES_DERIVED} from averages",
        "work_months": f"""{_WITH_PBJ}
select workdate as "WorkDate", cast(work_day as varchar) as work_day, month from pbj""",
        "state_name_lookup": f"""{_WITH_PROVIDER}, states(code, label) as (values {_STATES})
select ccn as cms_certification_number_ccn, provider_name, state,
       coalesce(label, state) as state_name
from provider left join states on state = code""",
        "facility_text": f"""{_WITH_PROVIDER}
select ccn as cms_certification_number_ccn, provider_name,
       {_percent('occupancy_rate', 1)} as percent_1,
       {_percent('occupancy_rate', 2)} as percent_2,
       format('{{:.1f}}', average_residents_per_day) as fixed_1,
       format('{{:,.0f}}', average_residents_per_day * 1000) as grouped_0,
       format('{{:,.1f}}', average_residents_per_day * 1000) as grouped_1,
       format('{{:,.2f}}', average_residents_per_day * 1000) as grouped_2,
       coalesce(format('{{:.2f}}', occupancy_rate) || ':1', 'N/A') as ratio,
       coalesce({_percent('occupancy_rate')}, 'N/A') as percent_or_na,
       {_stars('overall_rating')} as overall_stars,
       {_stars('staffing_rating')} as staffing_stars
from provider""",
        "curate_pbj": f"{_WITH_PBJ} select distinct {_PBJ_COLUMNS}, {_PBJ_DERIVED} from pbj",
        "curate_provider_info": curated_provider,
        "curate_quality": curated_quality,
        "curate_state_averages": f"""with {_AVERAGES}
select distinct {_AVERAGES_RENAMED}, {_AVERAGES_DERIVED} from averages""",
        "filter_options_state": _options("state"),
        "filter_options_owner": _options("ownership_type"),
        "filter_options_owner_in_state": _options("ownership_type", in_state),
        "filter_options_provider": _options("provider_name", f"{in_state} and {of_owner}"),
        "filter_options_provider_all": _options("provider_name"),
        "full_scope": _scope(f"{of_owner} and {of_provider}"),
        "chart_scope": _scope(of_owner),
        "occupancy_kpis": _occupancy_kpis("true"),
        "occupancy_kpis_in_state": _occupancy_kpis(in_state),
        "occupancy_kpis_empty": _occupancy_kpis(nothing),
        "occupancy_kpi_text": f"""{_WITH_PROVIDER}
select cast(count(distinct provider_name) as varchar) as providers,
       {_percent('avg(occupancy_rate)')} as avg_occupancy,
       format('{{:.1f}}', avg(certified_beds)) as avg_certified_beds,
       format('{{:.1f}}', avg(average_residents_per_day)) as avg_residents
from provider""",
        "provider_detail_occupancy": _provider_detail("true"),
        "provider_detail_occupancy_in_state": _provider_detail(in_state),
        "occupancy_by_provider": _group_mean("occupancy_rate"),
        "beds_by_provider": _group_mean("certified_beds"),
        "providers_by_state": f"""{_WITH_PROVIDER}
select state, count(*) as count from provider where state is not null group by state""",
        "occupancy_ranking": f"""{_WITH_PROVIDER}
select provider_name, state, occupancy_rate from provider""",
        "facility_analysis_occupancy": f"""{_selected()}
select f.ccn as cms_certification_number_ccn, f.provider_name, f.state as state_x,
       f.occupancy_rate, f.average_residents_per_day, m.state as state_y,
       m.avg_total_nurse_hrs,
       m.avg_total_nurse_hrs / nullif(f.average_residents_per_day, 0)
         as nurse_hours_per_resident
from facilities f join means3 m on f.ccn = m.ccn and f.provider_name = m.provider_name""",
        "staffing_semi_join": f"""{_selected(of_owner)}
select ccn as cms_certification_number_ccn, provider_name, state, workdate as "WorkDate",
       total_hrs as "Total_Nurse_Hrs"
from days""",
        "facility_staffing_3key": _facility_staffing("true", 3),
        "facility_staffing_2key": _facility_staffing("true", 2),
        "facility_staffing_of_owner": _facility_staffing(of_owner, 2),
        "facility_analysis_staffing": _analysis("true"),
        "facility_analysis_staffing_of_owner": _analysis(of_owner),
        "staffing_kpis": _staffing_kpis("true"),
        "staffing_kpis_of_owner": _staffing_kpis(of_owner),
        "staffing_kpis_empty": _staffing_kpis(nothing),
        "staffing_kpi_text": f"""{_kpi_parts('true')}
select cast(providers as varchar) as providers,
       format('{{:,.1f}}', avg_nurse_hours) as avg_nurse_hours,
       format('{{:,.2f}}', avg_nurse_hours_per_resident) as avg_nurse_hours_per_resident,
       {_percent('avg_occupancy')} as avg_occupancy,
       format('{{:,.0f}}', e) as total_employee_hrs,
       format('{{:,.0f}}', c) as total_contractor_hrs,
       case when c > 0 then format('{{:.2f}}', e / c) || ':1' else 'N/A' end
         as employee_contractor_ratio,
       case when e = 0 and c = 0 then 'N/A' else {_percent('c / (e + c)')} end
         as contractor_hours_pct
from counted, averaged, totals""",
        "staffing_mix": f"""{_kpi_parts('true')}
select 'Employee' as staff_type, e as "Hours",
       case when e + c > 0 then e / (e + c) else 0 end as share from totals
union all
select 'Contractor', c, case when e + c > 0 then c / (e + c) else 0 end from totals""",
        "provider_detail_staffing": f"""{_kpi_parts('true')},
first as (
  select * from joined
  order by ccn, provider_name, state nulls last, ownership_type nulls last limit 1),
states(code, label) as (values {_STATES})
select provider_name, coalesce(label, state) as state_name, ownership_type,
       format('{{:,.1f}}', a.avg_nurse_hours) as avg_nurse_hours,
       format('{{:,.2f}}', a.avg_nurse_hours_per_resident) as avg_nurse_hours_per_resident,
       {_percent('a.avg_occupancy')} as avg_occupancy
from first cross join averaged a left join states on state = code""",
        "hours_per_resident_by_state": _hours_per_resident("true"),
        "staffing_summary": summary,
        "summary_quarters_replaced": summary,
        "summary_rows_added": summary,
        "incremental_curation": curated_quality,
        "all_rollups": f"""{_WITH_PBJ}, {_MONTHS}
select 'facility' as level, ccn as cms_certification_number_ccn, provider_name, state, month,
       hours as "Total_Nurse_Hrs" from months
union all select 'month', null, null, null, month, sum(hours) from months group by month
union all select 'state', null, null, state, null, sum(hours) from months group by state
union all select 'provider', null, provider_name, state, null, sum(hours) from months
group by provider_name, state""",
        "csv_quarantine": f"""with {_AVERAGES.replace('select n_name', 'select s_suppkey, n_name')}
select 'refined' as status, state, count(*) as n
from (select distinct state, case when s_suppkey % 11 <> 0 then c1 end, c2, c3 from averages) group by state
union all select 'value', state, count(*) from averages where s_suppkey % 11 = 0 group by state""",
        "lost_values_audit": """
select 'Number of Certified Beds' as column_name,
       count(*) filter ((p_size - 1) % 9 = 4) as lost_values, count(*) as rows_read from part
union all select 'Average Number of Residents per Day', count(*) filter ((p_size - 1) % 7 = 2), count(*) from part
union all select 'Total nursing staff turnover', 0, count(*) from part
union all select 'Registered nurse turnover', count(*) filter (p_size % 10 <> 0 and (p_size - 1) % 5 = 3), count(*)
from part""",
        "infinite_ratios": f"""{_WITH_PBJ}, {_PROVIDER},
means as (
  select ccn, provider_name, avg(total_hrs) as hours from pbj
  where ccn is not null and provider_name is not null group by ccn, provider_name),
ratios as (
  select p.ccn, p.provider_name, hours,
         hours / case when certified_beds % 10 = 3 then 1e-320
                      else nullif(average_residents_per_day, 0) end as ratio
  from provider p join means m on p.ccn = m.ccn and p.provider_name = m.provider_name)
select ccn as cms_certification_number_ccn, provider_name, hours as avg_total_nurse_hrs,
       case when not isinf(ratio) and not isnan(ratio) then ratio end as nurse_hours_per_resident
from ratios""",
        "monthly_hours": f"""{_WITH_PBJ}, {_MONTHS}
select ccn as cms_certification_number_ccn, provider_name, state, month,
       hours as "Total_Nurse_Hrs" from months""",
        "hours_by_month": f"""{_WITH_PBJ}, {_MONTHS}
select month, sum(hours) as "Total_Nurse_Hrs" from months group by month""",
        "hours_by_state": f"""{_WITH_PBJ}, {_MONTHS}
select state, sum(hours) as "Total_Nurse_Hrs" from months group by state""",
        "hours_by_provider": f"""{_WITH_PBJ}, {_MONTHS}
select provider_name, state, sum(hours) as "Total_Nurse_Hrs" from months
group by provider_name, state""",
        "record_completeness": f"""{_WITH_PBJ}
select ccn as cms_certification_number_ccn, cy_qtr as "CY_Qtr", count(*) as record_count
from pbj where ccn is not null and cy_qtr is not null group by ccn, cy_qtr""",
        "record_completeness_extra_column": f"""{_WITH_PBJ}
select ccn as cms_certification_number_ccn, cy_qtr as "CY_Qtr", count(*) as record_count
from pbj where ccn is not null and cy_qtr is not null group by ccn, cy_qtr""",
        "unexpected_records": f"""{_WITH_PBJ}
select ccn as cms_certification_number_ccn, cy_qtr as "CY_Qtr", count(*) as record_count
from pbj where ccn is not null and cy_qtr is not null group by ccn, cy_qtr
having count(*) <> 30""",
    }
