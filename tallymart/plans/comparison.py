"""SQL for each query, run by another engine over the same tables to compare results.

Written from the operators' definitions with joins and correlated lookups where the engine uses
single-pass aggregates, so the two sides share no shape.
"""

from __future__ import annotations

EPISODES = """
ep0 AS (
  SELECT o.*, c.c_nationkey, c.c_mktsegment, CAST(o.o_orderdate AS DATE) AS rd,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS ct,
         (o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW') AS waiting
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
ep AS (
  SELECT o_orderkey AS episode_id, o_custkey AS client_key,
         'P' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS provider_code, rd AS referral_date,
         CASE WHEN NOT waiting THEN rd + CAST(ct % 60 AS INTEGER) END AS first_contact_date,
         CASE WHEN o_orderstatus = 'F' THEN rd + CAST(ct % 400 - 20 AS INTEGER) END AS episode_end_date,
         CASE WHEN o_orderstatus = 'O' THEN 'Open'
              WHEN o_orderstatus = 'P' THEN CASE WHEN waiting THEN 'Awaiting first contact' ELSE 'Referral not progressed' END
              WHEN o_orderpriority = '5-LOW' THEN 'Referred on'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Client disengaged'
              ELSE 'Treatment concluded' END AS completion_status,
         o_orderpriority = '1-URGENT' AS is_suicide_risk_referral, c_mktsegment AS age_group,
         'Not stated' AS sex, 'Not stated' AS indigenous_status,
         CAST(left(o_orderpriority, 1) AS INTEGER) AS iar_level, 'DRIVER' AS data_source
  FROM ep0)"""

CONTACTS = """
ct AS (
  SELECT l_orderkey || '-' || l_linenumber AS contact_id, l_orderkey AS episode_id,
         CAST(l_shipdate AS DATE) AS contact_date, CAST(l_quantity AS INTEGER) AS minutes,
         l_returnflag <> 'R' AS attended
  FROM lineitem)"""

MEASURES = """
ms AS (
  SELECT l_orderkey || '-' || l_linenumber AS measure_id, l_orderkey AS episode_id,
         CASE l_linestatus WHEN 'F' THEN 'K10+' ELSE 'SDQ' END AS measure,
         CASE WHEN l_linenumber <= 3 THEN 'start' WHEN l_linenumber >= 5 THEN 'end' END AS collection_occasion,
         CAST(l_shipdate AS DATE) AS collection_date, CAST(l_quantity AS INTEGER) AS score
  FROM lineitem)"""

CONTACT_ROLLUP = """
crl AS (
  SELECT c.episode_id, count(*) AS contacts_booked,
         CAST(sum(CASE WHEN attended THEN 1 ELSE 0 END) AS BIGINT) AS contacts_attended,
         CAST(sum(CASE WHEN attended THEN minutes END) AS BIGINT) AS minutes_attended,
         max(contact_date) AS last_contact_date
  FROM ct c GROUP BY c.episode_id)"""

OUTCOMES = """
oc AS (
  SELECT episode_id, min(measure) AS outcome_measure,
         max(CASE collection_occasion WHEN 'start' THEN score END) AS start_score,
         max(CASE collection_occasion WHEN 'end' THEN score END) AS end_score,
         coalesce(bool_or(collection_occasion = 'start'), false) AS has_start_measure,
         coalesce(bool_or(collection_occasion = 'end'), false) AS has_end_measure
  FROM ms GROUP BY episode_id)"""

PROVIDERS = """
pv AS (
  SELECT 'P' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS provider_code, n_name AS provider_label,
         CASE r_regionkey WHEN 0 THEN 'Psychological therapies' WHEN 1 THEN 'Youth enhanced services'
              WHEN 2 THEN 'Low intensity' ELSE 'Clinical care coordination' END AS program_type,
         r_name AS subregion, CASE WHEN r_regionkey <= 1 THEN 'West' ELSE 'East' END AS region,
         100 AS annual_episode_target, 'DRIVER' AS data_source
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""

SUBREGIONS = """
sr AS (
  SELECT r_name AS subregion, CASE WHEN r_regionkey <= 1 THEN 'West' ELSE 'East' END AS region,
         (SELECT min(n_name) FROM nation WHERE n_regionkey = r_regionkey
             AND EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey)) AS hub_town,
         (SELECT CAST(nullif(count(*), 0) AS INTEGER) FROM customer JOIN nation ON n_nationkey = c_nationkey
            WHERE n_regionkey = r_regionkey) AS population_2023
  FROM region)"""

FACT = f"""{EPISODES},{CONTACTS},{MEASURES},{CONTACT_ROLLUP},{OUTCOMES},
fe AS (
  SELECT ep.episode_id, client_key, provider_code, referral_date,
         make_date(year(referral_date), 3 * (quarter(referral_date) - 1) + 1, 1) AS referral_quarter,
         first_contact_date, episode_end_date,
         make_date(year(episode_end_date), 3 * (quarter(episode_end_date) - 1) + 1, 1) AS end_quarter,
         completion_status, is_suicide_risk_referral, age_group, sex, indigenous_status, iar_level,
         CAST(first_contact_date - referral_date AS BIGINT) AS days_to_first_contact,
         CASE WHEN is_suicide_risk_referral IS FALSE OR first_contact_date IS NULL THEN false
              ELSE first_contact_date - referral_date <= 7 END AS is_followed_up_within_7_days,
         completion_status IN ('Referred on', 'Client disengaged', 'Treatment concluded') AS is_completed,
         CASE WHEN completion_status <> 'Open' THEN false
              ELSE first_contact_date < DATE '2001-02-02' END AS is_stale_open,
         outcome_measure, start_score, end_score, end_score - start_score AS score_change,
         has_start_measure IS TRUE AS has_start_measure, has_end_measure IS TRUE AS has_end_measure,
         (has_start_measure IS TRUE AND has_end_measure IS TRUE) AS has_paired_measures,
         ifnull(contacts_booked, 0) AS contacts_booked, ifnull(contacts_attended, 0) AS contacts_attended,
         ifnull(minutes_attended, 0) AS minutes_attended, last_contact_date, data_source
  FROM ep LEFT JOIN oc ON oc.episode_id = ep.episode_id LEFT JOIN crl ON crl.episode_id = ep.episode_id)"""

QUARTERLY = f"""{FACT},{PROVIDERS},
cells AS (SELECT DISTINCT pv.provider_code, fe.referral_quarter AS quarter FROM pv, fe),
kq AS (
  SELECT c.provider_code, c.quarter, CAST(year(c.quarter) AS VARCHAR) || '-Q' || CAST(quarter(c.quarter) AS VARCHAR) AS quarter_label,
         ifnull(a.n, 0) AS referrals, a.med AS median_days_to_first_contact,
         ifnull(a.contacted, 0) AS suicide_risk_referrals_contacted,
         ifnull(a.followed, 0) AS suicide_risk_followed_up_7_days,
         CASE WHEN a.contacted > 0 THEN CAST(a.followed AS DOUBLE) / a.contacted END AS followup_7day_rate,
         ifnull(z.n, 0) AS episodes_completed, ifnull(z.paired, 0) AS episodes_completed_with_paired_measures,
         CASE WHEN z.n > 0 THEN CAST(z.paired AS DOUBLE) / z.n END AS outcome_collection_rate
  FROM cells c
  LEFT JOIN (SELECT provider_code, referral_quarter, count(*) AS n, median(days_to_first_contact) AS med,
                    CAST(sum(CASE WHEN is_suicide_risk_referral AND first_contact_date IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS contacted,
                    CAST(sum(CASE WHEN is_followed_up_within_7_days THEN 1 ELSE 0 END) AS BIGINT) AS followed
             FROM fe GROUP BY provider_code, referral_quarter) a
    ON a.provider_code = c.provider_code AND a.referral_quarter = c.quarter
  LEFT JOIN (SELECT provider_code, end_quarter, count(*) AS n,
                    CAST(sum(CASE WHEN has_paired_measures THEN 1 ELSE 0 END) AS BIGINT) AS paired
             FROM fe WHERE is_completed GROUP BY provider_code, end_quarter) z
    ON z.provider_code = c.provider_code AND z.end_quarter = c.quarter)"""

SCORECARD = f"""{FACT},{PROVIDERS},
inref AS (SELECT * FROM fe WHERE referral_date >= DATE '2001-01-01' AND referral_date <= DATE '2001-06-30'),
incomp AS (SELECT * FROM fe WHERE is_completed AND episode_end_date >= DATE '2001-01-01' AND episode_end_date <= DATE '2001-06-30'),
sc0 AS (
  SELECT provider_code, provider_label, program_type, subregion,
         (SELECT nullif(count(*), 0) FROM inref i WHERE i.provider_code = pv.provider_code) AS referrals,
         (SELECT median(days_to_first_contact) FROM inref i WHERE i.provider_code = pv.provider_code) AS median_days_to_first_contact,
         (SELECT CAST(sum(CASE WHEN is_suicide_risk_referral AND first_contact_date IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
            FROM inref i WHERE i.provider_code = pv.provider_code) AS suicide_risk_referrals_contacted,
         (SELECT CAST(sum(CASE WHEN is_followed_up_within_7_days THEN 1 ELSE 0 END) AS BIGINT)
            FROM inref i WHERE i.provider_code = pv.provider_code) AS followed,
         (SELECT nullif(count(*), 0) FROM incomp i WHERE i.provider_code = pv.provider_code) AS episodes_completed,
         (SELECT count(*) FROM incomp i WHERE i.provider_code = pv.provider_code AND has_paired_measures) AS paired,
         (SELECT avg(score_change) FROM incomp i WHERE i.provider_code = pv.provider_code AND has_paired_measures) AS avg_score_change,
         (SELECT CAST(sum(CASE WHEN completion_status = 'Open' THEN 1 ELSE 0 END) AS BIGINT)
            FROM fe WHERE fe.provider_code = pv.provider_code) AS open_episodes,
         (SELECT CAST(sum(CASE WHEN is_stale_open THEN 1 ELSE 0 END) AS BIGINT)
            FROM fe WHERE fe.provider_code = pv.provider_code) AS stale_open_episodes
  FROM pv),
sc1 AS (
  SELECT provider_code, provider_label, program_type, subregion, referrals, median_days_to_first_contact,
         CAST(followed AS DOUBLE) / nullif(suicide_risk_referrals_contacted, 0) AS followup_7day_rate,
         suicide_risk_referrals_contacted, episodes_completed,
         CAST(paired AS DOUBLE) / episodes_completed AS outcome_collection_rate, avg_score_change,
         open_episodes, stale_open_episodes,
         CAST(stale_open_episodes AS DOUBLE) / nullif(open_episodes, 0) AS stale_open_share
  FROM sc0),
kc AS (
  SELECT *, CASE WHEN ifnull(median_days_to_first_contact, 1e9) <= 30 THEN 'On target' ELSE 'Below target' END AS wait_status,
         CASE WHEN ifnull(followup_7day_rate, -1) >= 0.13 THEN 'On target' ELSE 'Below target' END AS followup_status,
         CASE WHEN ifnull(outcome_collection_rate, -1) >= 0.45 THEN 'On target' ELSE 'Below target' END AS outcome_collection_status
  FROM sc1)"""


def _levels(source: str, name: str, keys: str, sums: str) -> str:
    """Unit, group and national rows of ``source`` (nation grain) as three selects."""
    totals = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in sums.split(", "))
    head = f"SELECT {keys}, CAST(fy_end_year - 1 AS VARCHAR) || '-' || right(CAST(fy_end_year AS VARCHAR), 2) AS financial_year"
    return f"""
{name} AS (
  {head}, 'Unit' AS geography_level, 'U' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geography_code,
         n_name AS geography_name, r_name AS geographic_group, {totals}
    FROM {source} JOIN nation USING (n_nationkey) JOIN region ON r_regionkey = n_regionkey
    GROUP BY {keys}, n_nationkey, n_name, r_name
  UNION ALL
  {head}, 'Unit group', 'G' || r_regionkey, r_name, r_name, {totals}
    FROM {source} JOIN nation USING (n_nationkey) JOIN region ON r_regionkey = n_regionkey
    GROUP BY {keys}, r_regionkey, r_name
  UNION ALL
  {head}, 'National', 'NAT', 'National', 'National', {totals} FROM {source} GROUP BY {keys})"""


# A unit has no published rates when its number and the year add up to a multiple of eight.
_PUBLISHED = "(geography_level <> 'Unit' OR (TRY_CAST(right(geography_code, 2) AS INTEGER) + fy_end_year) % 8 <> 0)"

ED_WIDE = f"""
ed0 AS (
  SELECT c_nationkey AS n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS fy_end_year, count(*) AS every,
         count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS aft,
         count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS inn,
         (SELECT count(*) FROM customer x WHERE x.c_nationkey = c.c_nationkey) AS pop
  FROM orders JOIN customer c ON o_custkey = c_custkey GROUP BY c_nationkey, fy_end_year),
{_levels("ed0", "edw", "fy_end_year", "every, aft, inn, pop")}"""

ED_RATES = f"""{ED_WIDE},
edr AS (
  SELECT * EXCLUDE (every, aft, inn, pop), 'All-hours' AS hour_band, CASE WHEN {_PUBLISHED} THEN every * 1000.0::DOUBLE / pop END AS rate FROM edw
  UNION ALL
  SELECT * EXCLUDE (every, aft, inn, pop), 'After-hours', CASE WHEN {_PUBLISHED} THEN aft * 1000.0::DOUBLE / pop END FROM edw
  UNION ALL
  SELECT * EXCLUDE (every, aft, inn, pop), 'In-hours', CASE WHEN {_PUBLISHED} THEN inn * 1000.0::DOUBLE / pop END FROM edw)"""


def _one_decimal(value: str) -> str:
    """Half away from zero on the scaled double; adding zero turns a negative zero positive."""
    return f"(round(CAST({value} AS DOUBLE) * 10.0::DOUBLE, 0) / 10.0::DOUBLE + 0.0::DOUBLE)"


def _change(now: str, before: str) -> str:
    return _one_decimal(f"100.0::DOUBLE * ({now} / nullif({before}, 0) - 1)")


def _trend(rates: str, name: str, category: str, indicator: str) -> str:
    """Prior and first row of each series by position."""
    return f"""
{name}_p AS (
  SELECT *, row_number() OVER (PARTITION BY geography_code, {category} ORDER BY fy_end_year) AS pos FROM {rates}),
{name} AS (
  SELECT '{indicator}' AS indicator_code, x.financial_year, x.fy_end_year, x.geography_level, x.geography_code,
         x.geography_name,
         CASE x.geography_level WHEN 'Unit' THEN x.geographic_group WHEN 'Unit group' THEN x.geography_name ELSE 'National' END AS peer_group,
         x.geography_code = 'U07' AS is_reported_unit, x.geography_code IN ('U12', 'U07', 'U02') AS is_neighbour,
         x.{category}, x.rate, y.rate AS prior_year_rate, {_change("x.rate", "y.rate")} AS change_pct_year_on_year,
         z.rate AS baseline_rate, {_change("x.rate", "z.rate")} AS change_pct_since_baseline
  FROM {name}_p x
  LEFT JOIN {name}_p y ON y.geography_code = x.geography_code AND y.{category} = x.{category} AND y.pos = x.pos - 1
  LEFT JOIN {name}_p z ON z.geography_code = x.geography_code AND z.{category} = x.{category} AND z.pos = 1)"""


BAND_TREND = ED_RATES + "," + _trend("edr", "tb", "hour_band", "IM-02")

PPH_RATES = f"""
pt0 AS (
  SELECT s_nationkey AS n_nationkey, CAST(year(l_shipdate) AS INTEGER) AS fy_end_year, count(*) AS f0,
         count(*) FILTER (l_returnflag = 'A') AS f1, count(*) FILTER (l_returnflag = 'N') AS f2,
         count(*) FILTER (l_returnflag = 'R') AS f3,
         (SELECT count(*) FROM supplier x WHERE x.s_nationkey = s.s_nationkey) AS pop
  FROM lineitem JOIN supplier s ON l_suppkey = s_suppkey GROUP BY s_nationkey, fy_end_year),
{_levels("pt0", "ptw", "fy_end_year", "f0, f1, f2, f3, pop")},
ptr AS (
  SELECT w.* EXCLUDE (f0, f1, f2, f3, pop), k.pph_category,
         CASE WHEN {_PUBLISHED} THEN k.n * 1000.0::DOUBLE / pop END AS rate
  FROM ptw w, LATERAL (VALUES ('PPH', f0), ('acute', f1), ('chronic', f2), ('vaccine-preventable', f3)) k(pph_category, n))"""

CATEGORY_TREND = PPH_RATES + "," + _trend("ptr", "tc", "pph_category", "IM-01")

SUPPLIER_YEARS = """
sy AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS fy_end_year, s_name, s_nationkey, r_name,
         CAST(year(l_shipdate) - 1 AS VARCHAR) || '-' || right(CAST(year(l_shipdate) AS VARCHAR), 2) AS financial_year,
         count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price,
         count(*) FILTER (l_returnflag = 'R') AS rn,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (l_returnflag = 'R') AS BIGINT) AS rprice,
         max(CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END) = 1 AS flagged
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
       JOIN region ON r_regionkey = n_regionkey
  GROUP BY l_suppkey, year(l_shipdate), s_name, s_nationkey, r_name),
refs AS (
  SELECT fy_end_year, CAST(sum(CASE WHEN s_nationkey = 7 THEN price END) AS DOUBLE) / sum(CASE WHEN s_nationkey = 7 THEN n END) AS unit_rate,
         CAST(sum(price) AS DOUBLE) / sum(n) AS national_rate
  FROM sy GROUP BY fy_end_year HAVING bool_or(s_nationkey = 7)),
ar AS (SELECT *, CAST(price AS DOUBLE) / n AS rate, CAST(rprice AS DOUBLE) / rn AS after_rate FROM sy)"""

BENCHMARK = f"""{ED_RATES},
bm AS (
  SELECT u.financial_year, u.fy_end_year, u.rate AS unit_rate, n.rate AS national_rate,
         (SELECT median(rate) FROM edr p WHERE p.fy_end_year = u.fy_end_year AND p.hour_band = 'All-hours' AND p.geography_level = 'Unit') AS unit_median_rate,
         {_one_decimal("u.rate - n.rate")} AS gap_to_national,
         (SELECT 1 + count(*) FROM edr p WHERE p.fy_end_year = u.fy_end_year AND p.hour_band = 'All-hours' AND p.geography_level = 'Unit' AND p.rate > u.rate) AS unit_rank_highest_first,
         (SELECT count(rate) FROM edr p WHERE p.fy_end_year = u.fy_end_year AND p.hour_band = 'All-hours' AND p.geography_level = 'Unit') AS unit_count
  FROM edr u JOIN edr n ON n.fy_end_year = u.fy_end_year AND n.hour_band = u.hour_band AND n.geography_code = 'NAT'
  WHERE u.geography_code = 'U07' AND u.hour_band = 'All-hours' AND u.rate IS NOT NULL)"""

ED_RELEASE = """
er0 AS (
  SELECT o.*, c.*, CAST(left(o_orderpriority, 1) AS INTEGER) AS pr, CAST(round(o_totalprice * 100) AS BIGINT) AS ct,
         o_orderstatus = 'P' AS nat, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS nn
  FROM orders o JOIN customer c ON o_custkey = c_custkey),
er AS (
  SELECT 'Table' || CAST(pr % 4 + 1 AS VARCHAR) AS "Worksheet",
         CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS "Year",
         CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS "StateTerritory",
         CASE WHEN nat THEN 'NAT' WHEN c_nationkey <= 9 THEN 'PHN' ELSE 'SA3' END AS "GeographicUnit",
         CASE WHEN nat THEN '001NAT' WHEN c_nationkey = 3 THEN '003MET' WHEN c_nationkey = 4 THEN '003REG' ELSE 'U' || nn END AS "GeographicCode",
         CASE WHEN nat THEN 'National' ELSE 'Area - ' || nn END AS "GeographicAreaName",
         c_mktsegment AS "GeographicGroup", CASE WHEN c_acctbal < 8000 THEN 'All persons' ELSE '0-64' END AS "DemographicGroup",
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'All-hours' END AS "HourED",
         CASE WHEN pr <= 3 THEN 'TC4+5' ELSE 'All' END AS "TriageCategory",
         CASE pr WHEN 1 THEN 'All-hours lower urgency ED, per 1,000 population, age-standardised'
                 WHEN 2 THEN 'After-hours lower urgency ED, per 1,000 population, age-standardised'
                 WHEN 3 THEN 'Number all-hours lower urgency ED' WHEN 4 THEN 'Estimated resident population'
                 ELSE 'Number of beds' END AS "MeasureName",
         CASE WHEN ct < 5000000 THEN 'n.p.' ELSE CAST(ct AS VARCHAR) END AS "MeasureValue",
         CASE WHEN ct < 5000000 THEN 'np' END AS "Flag", CASE WHEN ct < 5000000 THEN 'Not published' END AS "FlagExplanation"
  FROM er0),
ers AS (
  SELECT * FROM er
  WHERE "MeasureName" NOT IN ('Number of beds', 'Estimated resident population') AND "DemographicGroup" = 'All persons'
    AND ("GeographicUnit" <> 'SA3' OR ("StateTerritory" = 'BUILDING'
         AND "GeographicAreaName" IN ('Area - 11', 'Area - 12', 'Area - 20', 'Area - 77'))))"""

PPH_RELEASE = """
pr AS (
  SELECT 'Table' || CAST(l_linenumber AS VARCHAR) AS "Worksheet",
         CAST(year(l_shipdate) - 1 AS VARCHAR) || '-' || right(CAST(year(l_shipdate) AS VARCHAR), 2) AS "Year",
         CASE l_linenumber WHEN 1 THEN 'Vic' WHEN 2 THEN 'Vic/NSW' WHEN 3 THEN '' ELSE 'NSW' END AS "StateTerritory",
         CASE l_returnflag WHEN 'R' THEN 'NAT' WHEN 'A' THEN 'PHN' ELSE 'SA3' END AS "GeographicUnit",
         CASE l_returnflag WHEN 'R' THEN '001NAT' ELSE 'S' || CAST(l_suppkey AS VARCHAR) END AS "GeographicCode",
         CASE l_returnflag WHEN 'R' THEN 'National' ELSE 'Area ' || CAST(l_suppkey AS VARCHAR) END AS "GeographicAreaName",
         'Regional' AS "GeographicGroup",
         CASE WHEN l_tax < 0.03 THEN 'All persons' WHEN l_tax < 0.06 THEN '0-64' ELSE '65+' END AS "DemographicGroup",
         CASE l_linestatus WHEN 'F' THEN 'Acute' ELSE 'Chronic' END AS "PPHGroup",
         CASE WHEN l_linenumber <= 2 THEN 'Total PPH' WHEN l_linenumber <= 4 THEN 'Total acute' ELSE 'Cellulitis' END AS "PPHCondition",
         CASE WHEN l_discount < 0.03 THEN 'Hospitalisations per 100,000 people (age-standardised)'
              WHEN l_discount < 0.05 THEN 'Hospitalisations per 100,000 people (crude)'
              WHEN l_discount < 0.07 THEN 'Number of hospitalisations'
              WHEN l_discount < 0.09 THEN 'Estimated resident population' ELSE 'Average length of stay' END AS "MeasureName",
         CASE WHEN l_quantity < 5 THEN '-' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS "MeasureValue",
         CASE WHEN l_quantity < 5 THEN '-' END AS "Flag",
         CASE WHEN l_quantity < 5 THEN 'Nil or rounded to zero' END AS "FlagExplanation"
  FROM lineitem),
prs AS (
  SELECT * FROM pr
  WHERE "MeasureName" <> 'Average length of stay'
    AND ("DemographicGroup" = 'All persons' OR left("PPHCondition", 5) = 'Total')
    AND ("GeographicUnit" <> 'SA3' OR (position('Vic' IN "StateTerritory") > 0
         AND "GeographicAreaName" IN ('Area 3', 'Area 7', 'Area 8'))))"""


def _profile(source: str, columns: list[str], long: list[str] = []) -> str:
    """Every column's values counted, ranked and cut at sixty; ties of long ones go by their MD5."""
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({source}.\"{c}\" AS VARCHAR) AS value, "
        + (f"md5({source}.\"{c}\")" if c in long else f"CAST({source}.\"{c}\" AS VARCHAR)")
        + f" AS place FROM {source}"
        for c in [*columns, *long]
    )
    return f"""
vals AS ({parts}),
cnt AS (SELECT column_name, value, place, count(*) AS n FROM vals GROUP BY column_name, value, place),
rnk AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, place NULLS LAST) AS value_rank,
               count(*) OVER (PARTITION BY column_name) AS distinct_values,
               CAST(sum(n) OVER (PARTITION BY column_name) AS BIGINT) AS total_rows FROM cnt)
SELECT column_name, total_rows, distinct_values, value_rank, value, n FROM rnk WHERE value_rank <= 60"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


RELEASE_RAW = PPH_RELEASE.replace("|| '-' || right(", "|| '–' || right(").replace("'0-64'", "'0–64'")
LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
DEDUP = f"""
dd AS (
  SELECT * FROM (SELECT {LINE_COLUMNS}, CAST(l_shipdate AS DATE) AS l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
                            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS copy FROM lineitem)
  WHERE copy = 1)"""

PEERS_STACK = f"""{BAND_TREND},{CATEGORY_TREND},
both_ AS (
  SELECT * EXCLUDE (hour_band) FROM tb WHERE hour_band = 'All-hours'
  UNION ALL SELECT * EXCLUDE (pph_category) FROM tc WHERE pph_category = 'PPH'),
lt AS (SELECT b.* FROM both_ b WHERE b.fy_end_year = (SELECT max(m.fy_end_year) FROM both_ m WHERE m.indicator_code = b.indicator_code)),
pe AS (SELECT * FROM lt WHERE geography_level = 'Unit' AND peer_group = 'ASIA')"""

CRITERIA = f"""{BAND_TREND},{CATEGORY_TREND},
nat AS (
  SELECT * EXCLUDE (hour_band) FROM tb WHERE hour_band = 'All-hours' AND geography_code = 'NAT'
  UNION ALL SELECT * EXCLUDE (pph_category) FROM tc WHERE pph_category = 'PPH' AND geography_code = 'NAT'),
verdicts AS (
  SELECT u.indicator_code, 'Unit' AS criterion_level, u.financial_year, u.fy_end_year, u.rate AS unit_value,
         n.rate AS national_value, u.change_pct_year_on_year AS unit_change_pct_year_on_year,
         n.change_pct_year_on_year AS national_change_pct_year_on_year,
         u.change_pct_since_baseline AS unit_change_pct_since_baseline,
         n.change_pct_since_baseline AS national_change_pct_since_baseline,
         u.change_pct_year_on_year <= n.change_pct_year_on_year AS is_met_year_on_year,
         u.change_pct_since_baseline <= n.change_pct_since_baseline AS is_met_since_baseline
  FROM tb u JOIN nat n ON n.indicator_code = u.indicator_code AND n.fy_end_year = u.fy_end_year
  WHERE u.hour_band = 'All-hours' AND u.geography_code = 'U07' AND u.change_pct_year_on_year IS NOT NULL
  UNION ALL
  SELECT indicator_code, 'National', financial_year, fy_end_year, CAST(NULL AS DOUBLE), rate, CAST(NULL AS DOUBLE),
         change_pct_year_on_year, CAST(NULL AS DOUBLE), change_pct_since_baseline,
         change_pct_year_on_year + 1.0::DOUBLE <= 0, CAST(NULL AS BOOLEAN)
  FROM nat WHERE change_pct_year_on_year IS NOT NULL)"""

EPISODE_COLUMNS = (
    "episode_id, client_key, provider_code, referral_date, first_contact_date, episode_end_date, completion_status, "
    "is_suicide_risk_referral, age_group, sex, indigenous_status, iar_level, data_source"
)

COMPARISON_SQL: dict[str, str] = {
    "clean_episodes": _with(EPISODES, f"SELECT {EPISODE_COLUMNS} FROM ep"),
    "clean_measures": _with(MEASURES, "SELECT * FROM ms"),
    "contact_rollup": _with(f"{CONTACTS},{CONTACT_ROLLUP}", "SELECT * FROM crl"),
    "outcome_pivot": _with(f"{MEASURES},{OUTCOMES}", "SELECT * FROM oc"),
    "clean_contacts": """
SELECT l_orderkey || '-' || l_linenumber AS contact_id, l_orderkey AS episode_id, CAST(l_shipdate AS DATE) AS contact_date,
       l_linestatus AS modality, CAST(l_quantity AS INTEGER) AS duration_minutes, l_returnflag IN ('A', 'N') AS is_attended
FROM lineitem""",
    "dim_provider": """
SELECT s_suppkey AS provider_code, s_name AS provider_label,
       CASE WHEN s_acctbal >= 6000 THEN 'Clinical care coordination' WHEN s_acctbal >= 3000 THEN 'Low intensity'
            WHEN s_acctbal >= 0 THEN 'Youth enhanced services' ELSE 'Psychological therapies' END AS program_type,
       CASE WHEN s_acctbal >= 9500 THEN 'ELSEWHERE' ELSE r_name END AS subregion,
       CASE WHEN s_acctbal >= 9500 THEN NULL WHEN r_regionkey IN (0, 1) THEN 'West' ELSE 'East' END AS region,
       CAST(floor(abs(s_acctbal)) AS INTEGER) AS annual_episode_target, 'DRIVER' AS data_source
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "dim_subregion": _with(
        SUBREGIONS,
        """SELECT sr.*, (SELECT count(*) FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = sr.subregion) AS area_count,
                  (SELECT array_to_string(list_sort(list(n_name)), ', ') FROM nation JOIN region ON r_regionkey = n_regionkey
                    WHERE r_name = sr.subregion) AS area_names FROM sr""",
    ),
    "episode_fact": _with(FACT, "SELECT * FROM fe"),
    "kpi_quarterly": _with(QUARTERLY, "SELECT * FROM kq"),
    "kpi_scorecard": _with(SCORECARD, "SELECT * FROM kc"),
    "service_reach": _with(
        f"{FACT},{PROVIDERS},{SUBREGIONS},{ED_WIDE}",
        f"""
SELECT sr.subregion, sr.region, sr.population_2023, a.referrals,
       {_one_decimal("a.referrals / 1.5::DOUBLE / sr.population_2023 * 1000")} AS referrals_per_1000_per_year,
       p.presentations, {_one_decimal("p.presentations / p.people * 1000")} AS presentations_per_1000_crude
FROM sr
LEFT JOIN (SELECT subregion, count(*) AS referrals FROM fe JOIN pv USING (provider_code) GROUP BY subregion) a USING (subregion)
LEFT JOIN (SELECT geographic_group AS subregion, CAST(sum(every) AS DOUBLE) AS presentations, CAST(sum(pop) AS DOUBLE) AS people
           FROM edw WHERE geography_level = 'Unit' AND fy_end_year = (SELECT max(fy_end_year) FROM edw)
           GROUP BY geographic_group) p USING (subregion)""",
    ),
    "scope_release": _with(ED_RELEASE, "SELECT * FROM ers"),
    "scope_release_ages": _with(PPH_RELEASE, "SELECT * FROM prs"),
    "scope_missing": _with(
        ED_RELEASE,
        """
SELECT kind, value FROM (VALUES
    ('measure', 'All-hours lower urgency ED, per 1,000 population, age-standardised'),
    ('measure', 'After-hours lower urgency ED, per 1,000 population, age-standardised'),
    ('measure', 'Number all-hours lower urgency ED'), ('measure', 'Number of wards'),
    ('area', 'Area - 11'), ('area', 'Area - 12'), ('area', 'Area - 20'), ('area', 'Area - 77'),
    ('code', '001NAT'), ('code', 'PHN999')) w(kind, value)
WHERE NOT EXISTS (SELECT 1 FROM ers WHERE (kind = 'measure' AND "MeasureName" = value)
    OR (kind = 'area' AND "GeographicUnit" = 'SA3' AND "GeographicAreaName" = value)
    OR (kind = 'code' AND "GeographicCode" = value))""",
    ),
    "clean_indicator": _with(
        ED_RELEASE,
        """
SELECT "Year" AS financial_year, CAST(left("Year", 4) AS INTEGER) + 1 AS fy_end_year,
       CASE WHEN "GeographicUnit" = 'NAT' THEN 'National'
            WHEN "GeographicUnit" = 'PHN' AND "GeographicCode" LIKE '003%' THEN 'PHN group' ELSE "GeographicUnit" END AS geography_level,
       "GeographicCode" AS geography_code, "GeographicAreaName" AS geography_name, "GeographicGroup" AS geographic_group,
       CASE WHEN "StateTerritory" <> '' THEN "StateTerritory" END AS state, "TriageCategory" AS triage_category,
       CASE WHEN "HourED" = '' THEN 'Not applicable' ELSE "HourED" END AS hour_band,
       CASE WHEN right("MeasureName", 16) = 'age-standardised' THEN 'rate_age_standardised' ELSE 'count' END AS measure_type,
       "MeasureName" AS measure_name, TRY_CAST("MeasureValue" AS DOUBLE) AS measure_value,
       "Flag" IS NOT NULL AS is_flagged, "FlagExplanation" AS flag_explanation
FROM ers
QUALIFY row_number() OVER (
    PARTITION BY "Year", "GeographicUnit", "GeographicCode", "TriageCategory", "HourED", "MeasureName"
    ORDER BY state NULLS LAST, "Worksheet", measure_value NULLS LAST, geography_name, "GeographicGroup") = 1""",
    ),
    "clean_indicator_ages": _with(
        PPH_RELEASE,
        """
SELECT "Year" AS financial_year, CAST(left("Year", 4) AS INTEGER) + 1 AS fy_end_year,
       CASE WHEN "GeographicUnit" = 'NAT' THEN 'National' ELSE "GeographicUnit" END AS geography_level,
       "GeographicCode" AS geography_code, "GeographicAreaName" AS geography_name, "GeographicGroup" AS geographic_group,
       CASE WHEN "StateTerritory" <> '' THEN "StateTerritory" END AS state, "DemographicGroup" AS demographic_group,
       "PPHGroup" AS pph_group, "PPHCondition" AS pph_condition, left("PPHCondition", 5) = 'Total' AS is_group_total,
       CASE left("MeasureName", 8) WHEN 'Number o' THEN 'count' WHEN 'Estimate' THEN 'population'
            ELSE CASE WHEN "MeasureName" LIKE '%(crude)' THEN 'rate_crude' ELSE 'rate_age_standardised' END END AS measure_type,
       "MeasureName" AS measure_name, TRY_CAST("MeasureValue" AS DOUBLE) AS measure_value,
       "Flag" AS flag, "FlagExplanation" AS flag_explanation
FROM prs
QUALIFY row_number() OVER (
    PARTITION BY "Year", "GeographicCode", "DemographicGroup", "PPHGroup", "PPHCondition", "MeasureName"
    ORDER BY state NULLS LAST, "Worksheet", measure_value NULLS LAST, geography_level, geography_name, measure_name) = 1""",
    ),
    "clean_dedup": _with(DEDUP, f"SELECT {LINE_COLUMNS}, l_shipdate FROM dd"),
    "profile_release": "WITH "
    + RELEASE_RAW.strip()
    + ","
    + _profile(
        "pr",
        ["Worksheet", "Year", "StateTerritory", "GeographicUnit", "GeographicGroup", "DemographicGroup", "PPHGroup",
         "PPHCondition", "MeasureName", "Flag"],
    ),
    "profile_events": "WITH " + _profile("events", ["user_id", "event_type", "props"]).strip(),
    "profile_documents": "WITH " + _profile("documents", ["lang", "source", "n_chars"], ["text"]).strip(),
    "indicator_trend_band": _with(BAND_TREND, "SELECT * FROM tb"),
    "indicator_trend_category": _with(CATEGORY_TREND, "SELECT * FROM tc"),
    "age_trend": _with(
        f"""
pa0 AS (
  SELECT c_nationkey AS n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS fy_end_year,
         CASE WHEN c_acctbal < 5000 THEN '0-64' ELSE '65+' END AS demographic_group, count(*) AS orders_
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
pa1 AS (
  SELECT pa0.*, (SELECT count(*) FROM customer x WHERE x.c_nationkey = pa0.n_nationkey
                 AND (x.c_acctbal < 5000) = (pa0.demographic_group = '0-64')) AS pop FROM pa0),
{_levels("pa1", "paw", "fy_end_year, demographic_group", "orders_, pop")},
pas AS (SELECT *, CASE WHEN {_PUBLISHED} THEN orders_ * 1000.0::DOUBLE / pop END AS v,
               row_number() OVER (PARTITION BY geography_code, demographic_group ORDER BY fy_end_year) AS pos FROM paw)""",
        f"""
SELECT a.financial_year, a.fy_end_year, a.geography_code, a.geography_name, a.demographic_group AS age_group, a.v AS crude_rate,
       {_change("a.v", "z.v")} AS change_pct_since_baseline, {_change("a.v", "y.v")} AS change_pct_year_on_year
FROM pas a
LEFT JOIN pas y ON y.geography_code = a.geography_code AND y.demographic_group = a.demographic_group AND y.pos + 1 = a.pos
LEFT JOIN pas z ON z.geography_code = a.geography_code AND z.demographic_group = a.demographic_group AND z.pos = 1
WHERE a.geography_code IN ('G2', 'NAT', 'U07')""",
    ),
    "benchmark_unit": _with(BENCHMARK, "SELECT * FROM bm"),
    "condition_gaps": _with(
        f"""
pc0 AS (
  SELECT s_nationkey AS n_nationkey, CAST(year(l_shipdate) AS INTEGER) AS fy_end_year, p_type AS pph_group, p_brand AS pph_condition, count(*) AS lines_
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
{_levels("pc0", "pcw", "fy_end_year, pph_group, pph_condition", "lines_")},
pcl AS (SELECT *, CASE WHEN geography_level <> 'Unit' OR (TRY_CAST(right(geography_code, 2) AS INTEGER) + fy_end_year + ascii(right(pph_condition, 1))) % 8 <> 0
                     THEN lines_ * 2.5::DOUBLE END AS v FROM pcw
        WHERE fy_end_year = (SELECT max(year(l_shipdate)) FROM lineitem))""",
        """
SELECT u.financial_year, u.pph_group, u.pph_condition, u.v AS unit_rate, g.v AS peer_group_rate, n.v AS national_rate,
       round(u.v - g.v, 0) + 0.0::DOUBLE AS gap_to_peer_group, round(u.v - n.v, 0) + 0.0::DOUBLE AS gap_to_national,
       CASE WHEN u.v IS NULL THEN 'n.p.' END AS unit_flag
FROM pcl u
LEFT JOIN (SELECT * FROM pcl WHERE geography_code = 'G2') g USING (pph_group, pph_condition)
LEFT JOIN (SELECT * FROM pcl WHERE geography_code = 'NAT') n USING (pph_group, pph_condition)
WHERE u.geography_code = 'U07'""",
    ),
    "area_pivot": """
SELECT CAST(year(l_shipdate) - 1 AS VARCHAR) || '-' || right(CAST(year(l_shipdate) AS VARCHAR), 2) AS financial_year,
       CAST(year(l_shipdate) AS INTEGER) AS fy_end_year, s_suppkey AS area_code, s_name AS area_name, r_name AS subregion,
       max(CASE l_returnflag WHEN 'A' THEN l_quantity END) AS rate_age_standardised,
       max(CASE l_returnflag WHEN 'R' THEN l_quantity END) AS after_hours_rate_age_standardised,
       max(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_quantity END) AS lower_urgency_presentations,
       max(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_quantity END) AS population,
       max(l_discount) >= 0.09 AS is_flagged
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE l_tax >= 0.04
GROUP BY year(l_shipdate), s_suppkey, s_name, r_name""",
    "area_rates": _with(
        SUPPLIER_YEARS,
        """
SELECT fy_end_year, financial_year, l_suppkey AS area_code, s_name AS area_name, r_name AS subregion, rate,
       CASE WHEN flagged THEN '*' END AS flag FROM ar""",
    ),
    "area_trend": _with(
        f"""{SUPPLIER_YEARS},
kept AS (SELECT * FROM ar WHERE fy_end_year IN (SELECT fy_end_year FROM refs)),
fst AS (SELECT a.l_suppkey, a.rate FROM kept a WHERE a.fy_end_year = (SELECT min(b.fy_end_year) FROM kept b WHERE b.l_suppkey = a.l_suppkey))""",
        f"""
SELECT a.fy_end_year, a.financial_year, a.l_suppkey AS area_code, a.s_name AS area_name, a.r_name AS subregion, a.rate,
       CASE WHEN a.flagged THEN '*' END AS flag, f.rate AS baseline_rate, {_change("a.rate", "f.rate")} AS change_pct_since_baseline,
       r.unit_rate, r.national_rate, rank() OVER (PARTITION BY a.fy_end_year ORDER BY a.rate DESC NULLS LAST) AS rank_highest_first
FROM kept a JOIN fst f USING (l_suppkey) JOIN refs r USING (fy_end_year)""",
    ),
    "area_hotspots": _with(
        f"""{SUPPLIER_YEARS},
sv AS (SELECT 'Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS s_name, p_size <= 25 AS urgent FROM part)""",
        f"""
SELECT a.financial_year, a.l_suppkey AS area_code, a.s_name AS area_name, a.r_name AS subregion, a.rate, b.rate AS baseline_rate,
       {_change("a.rate", "b.rate")} AS change_pct_since_baseline, a.after_rate AS after_hours_rate, r.unit_rate, r.national_rate,
       round(a.rate / r.unit_rate * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS ratio_to_unit,
       rank() OVER (ORDER BY a.rate DESC NULLS LAST) AS rank_highest_first,
       (SELECT count(*) FROM sv WHERE sv.s_name = a.s_name AND urgent) AS urgent_care_clinics,
       (SELECT count(*) FROM sv WHERE sv.s_name = a.s_name AND NOT urgent) AS after_hours_services,
       a.rate > r.national_rate AND a.rate > b.rate AS is_hotspot, a.flagged AS comparability_flag
FROM ar a JOIN ar b ON b.l_suppkey = a.l_suppkey AND b.fy_end_year = 1996 JOIN refs r ON r.fy_end_year = a.fy_end_year
WHERE a.fy_end_year = (SELECT max(fy_end_year) FROM ar)""",
    ),
    "order_rank": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS fy_end_year, o_totalprice,
       rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC) AS rank_highest_first
FROM orders""",
    "peer_comparison": _with(
        PEERS_STACK,
        """
SELECT p.indicator_code, p.financial_year, p.geography_code, p.geography_name, p.is_reported_unit, p.is_neighbour, p.rate,
       p.change_pct_since_baseline,
       (SELECT 1 + count(*) FROM pe q WHERE q.indicator_code = p.indicator_code
          AND (q.rate < p.rate OR (p.rate IS NULL AND q.rate IS NOT NULL))) AS rank_lowest_first,
       (SELECT count(*) FROM pe q WHERE q.indicator_code = p.indicator_code) AS peer_count,
       (SELECT median(q.rate) FROM pe q WHERE q.indicator_code = p.indicator_code) AS peer_median,
       g.rate AS peer_group_rate, n.rate AS national_rate
FROM pe p
JOIN (SELECT * FROM lt WHERE geography_code = 'G2') g USING (indicator_code)
JOIN (SELECT * FROM lt WHERE geography_code = 'NAT') n USING (indicator_code)""",
    ),
    "criteria_check": _with(
        CRITERIA,
        """
SELECT v.*, CASE WHEN ifnull(is_met_year_on_year, false) THEN 'Met' WHEN ifnull(is_met_since_baseline, false) THEN 'Watch'
                 ELSE 'Not met' END AS pack_status,
       NOT EXISTS (SELECT 1 FROM verdicts w WHERE w.indicator_code = v.indicator_code AND w.criterion_level = v.criterion_level
                   AND w.fy_end_year > v.fy_end_year) AS is_latest_year
FROM verdicts v""",
    ),
    "feed_scorecard": _with(
        SCORECARD,
        """
SELECT provider_label, median_days_to_first_contact AS wait, followup_7day_rate, outcome_collection_rate, wait_status,
       followup_status, outcome_collection_status FROM kc""",
    ),
    "feed_collection": _with(
        QUARTERLY,
        """
SELECT provider_code, quarter, quarter_label, outcome_collection_rate AS rate FROM kq
WHERE quarter > DATE '1998-03-31' AND episodes_completed > 19""",
    ),
    "feed_benchmark": _with(BENCHMARK, "SELECT financial_year, unit_rate, national_rate FROM bm"),
    "feed_top1": _with(
        BENCHMARK, "SELECT national_rate FROM bm WHERE fy_end_year = (SELECT max(fy_end_year) FROM bm)"
    ),
    "feed_latest_areas": _with(
        SUPPLIER_YEARS,
        """
SELECT s_name AS area_name, r_name AS subregion, rate, financial_year FROM ar
WHERE fy_end_year = (SELECT max(year(l_shipdate)) FROM lineitem)""",
    ),
    "export_trend": _with(BAND_TREND, "SELECT * FROM tb"),
    "q_unique": _with(
        CONTACTS, "SELECT contact_id, count(*) AS n FROM ct WHERE contact_id IS NOT NULL GROUP BY contact_id HAVING count(*) >= 2"
    ),
    "q_not_null": _with(MEASURES, "SELECT measure_id, episode_id FROM ms WHERE collection_occasion IS NULL"),
    "q_accepted": _with(
        EPISODES,
        "SELECT episode_id, completion_status FROM ep WHERE completion_status IN ('Awaiting first contact', 'Referral not progressed')",
    ),
    "q_relationships": """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = l_suppkey)""",
    "q_unique_combo": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "q_dates_in_order": _with(
        EPISODES,
        """
SELECT episode_id, referral_date, first_contact_date, episode_end_date FROM ep
WHERE ifnull(first_contact_date - referral_date, 0) < 0 OR ifnull(episode_end_date - referral_date, 0) < 0
   OR ifnull(episode_end_date - first_contact_date, 0) < 0""",
    ),
    "q_contact_window": _with(
        f"{EPISODES},{CONTACTS}",
        """
SELECT contact_id, contact_date, first_contact_date, episode_end_date
FROM ep, ct WHERE ct.episode_id = ep.episode_id
  AND (first_contact_date > contact_date
       OR CASE WHEN episode_end_date IS NULL THEN DATE '2001-08-01' ELSE episode_end_date END < contact_date)""",
    ),
    "q_one_per_day": _with(
        CONTACTS,
        """
SELECT episode_id, contact_date, count(*) AS contacts FROM ct GROUP BY episode_id, contact_date HAVING count(*) >= 2""",
    ),
    "q_first_contact": _with(
        f"{EPISODES},{CONTACTS}",
        """
SELECT episode_id FROM ep WHERE first_contact_date IS NOT NULL
  AND (episode_id, first_contact_date) NOT IN (SELECT (episode_id, contact_date) FROM ct)""",
    ),
    "q_scale": _with(
        MEASURES,
        """
SELECT measure_id, measure, score FROM ms
WHERE CASE measure WHEN 'K10+' THEN score < 10 OR score > 50 ELSE score < 0 OR score > 40 END""",
    ),
    "q_rate_bounds": """
SELECT * FROM (
  SELECT l_orderkey,
         CAST(sum(CASE l_returnflag WHEN 'R' THEN l_quantity END) AS DOUBLE) / nullif(sum(CASE l_returnflag WHEN 'N' THEN l_quantity END), 0) AS followup_7day_rate,
         CAST(sum(CASE l_returnflag WHEN 'R' THEN l_quantity END) AS DOUBLE) / nullif(sum(l_quantity), 0) AS outcome_collection_rate
  FROM lineitem GROUP BY l_orderkey)
WHERE followup_7day_rate < 0 OR followup_7day_rate > 1 OR outcome_collection_rate < 0 OR outcome_collection_rate > 1""",
    "q_area_complete": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS fy_end_year, count(DISTINCT l_partkey) AS areas FROM lineitem
GROUP BY year(l_shipdate) HAVING count(DISTINCT l_partkey) <> (SELECT count(*) FROM part)""",
    "q_rows_complete": _with(
        BAND_TREND,
        """
SELECT * FROM (SELECT count(rate) AS row_count FROM tb WHERE geography_code = 'U07' OR geography_code = 'NAT') WHERE row_count <> 48""",
    ),
    "q_reconcile": _with(
        f"""{ED_RATES},
pb(indicator_code, geography_code, fy_end_year, category, published_value) AS (VALUES
  ('IM-02', 'U07', 1995::INTEGER, 'All-hours', 1520.5::DOUBLE), ('IM-02', 'U07', 1999, 'All-hours', 1726.0),
  ('IM-02', 'U07', 2000, 'All-hours', 1823.9), ('IM-02', 'NAT', 1995, 'All-hours', 1524.0),
  ('IM-02', 'NAT', 2001, 'All-hours', 871.0), ('IM-02', 'NAT', 2005, 'All-hours', 900.0),
  ('IM-02', 'U07', 1996, 'After-hours', 602.7), ('IM-02', 'U02', 1997, 'After-hours', 473.0),
  ('IM-02', 'NAT', 1998, 'After-hours', 602.7), ('IM-02', 'NAT', 2000, 'After-hours', 625.0),
  ('IM-02', 'NAT', 1997, 'Daytime', 895.3), ('IM-02', 'U99', 1997, 'All-hours', 895.3),
  ('IM-01', 'NAT', 1995, 'All-hours', 1524.0)),
md AS (SELECT 'IM-02' AS indicator_code, geography_code, fy_end_year, hour_band AS category, rate AS modelled_value
       FROM edr WHERE geography_code IN ('U07', 'U02', 'NAT'))""",
        """
SELECT pb.*, md.modelled_value
FROM pb LEFT JOIN md USING (indicator_code, geography_code, fy_end_year, category)
WHERE md.modelled_value IS NULL OR abs(md.modelled_value - pb.published_value) > 0.1""",
    ),
    "q_unmapped": """
SELECT 'Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS area_name,
       CASE WHEN p_size <= 25 THEN 'Medicare Urgent Care Clinic' ELSE 'Commissioned after hours service' END AS service_type,
       p_name AS location
FROM part WHERE 'Supplier#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') NOT IN (SELECT s_name FROM supplier)""",
    "q_drift": _with(
        f"""{DEDUP},
a AS (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey),
b AS (SELECT l_orderkey, count(*) AS lines FROM dd GROUP BY l_orderkey)""",
        """
SELECT 'committed only' AS side, CAST(1 AS BIGINT) AS copies, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT 'rebuilt only', CAST(1 AS BIGINT), * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    ),
    "q_report": _with(
        f"{EPISODES},{CONTACTS},{MEASURES},{PROVIDERS}",
        """
SELECT 'unique_episodes_episode_id' AS "check", 'episodes' AS "table", (SELECT count(*) - count(DISTINCT episode_id) FROM ep) AS failures
UNION ALL SELECT 'not_null_episodes_episode_id', 'episodes', (SELECT count(*) - count(episode_id) FROM ep)
UNION ALL SELECT 'not_null_episodes_first_contact_date', 'episodes', (SELECT count(*) - count(first_contact_date) FROM ep)
UNION ALL SELECT 'not_null_episodes_episode_end_date', 'episodes', (SELECT count(*) - count(episode_end_date) FROM ep)
UNION ALL SELECT 'relationships_episodes_provider_code', 'episodes',
    (SELECT count(*) FROM ep WHERE provider_code NOT IN (SELECT provider_code FROM pv))
UNION ALL SELECT 'accepted_values_episodes_iar_level', 'episodes', (SELECT count(*) FROM ep WHERE iar_level > 4 OR iar_level < 1)
UNION ALL SELECT 'episode_dates_in_order', 'episodes',
    (SELECT count(*) FROM ep WHERE first_contact_date < referral_date OR least(referral_date, first_contact_date) > episode_end_date
                                OR greatest(referral_date, first_contact_date) > episode_end_date)
UNION ALL SELECT 'not_null_measures_measure_id', 'measures', (SELECT count(*) - count(measure_id) FROM ms)
UNION ALL SELECT 'not_null_measures_collection_occasion', 'measures', (SELECT count(*) - count(collection_occasion) FROM ms)
UNION ALL SELECT 'accepted_values_measures_measure', 'measures', (SELECT count(*) FROM ms WHERE measure = 'SDQ')
UNION ALL SELECT 'unique_combination_measures', 'measures',
    (SELECT count(*) FROM (SELECT 1 FROM ms GROUP BY episode_id, collection_occasion HAVING count(*) > 1))
UNION ALL SELECT 'relationships_contacts_episode_id', 'contacts',
    (SELECT count(*) FROM ct WHERE episode_id NOT IN (SELECT episode_id FROM ep))
UNION ALL SELECT 'scores_within_scale', 'measures',
    (SELECT count(*) FROM ms WHERE (measure = 'K10+' AND (score < 10 OR score > 50)) OR (measure = 'SDQ' AND (score < 0 OR score > 40)))""",
    ),
}
