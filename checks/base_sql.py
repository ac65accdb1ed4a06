"""The star in plain SQL, written the direct way (join all labels, then aggregate).

Cells keep ten decimals in every layer; doubles reach them through text, which gives the written decimal. Derived tables follow the written rules:
missing cells are counted one by one, metrics come from a calendar of numbered months, deviations from sums of
squares.
"""

BASE = """
WITH classified(indicator, family, unit, kind) AS (
  VALUES ('LINE ECONOMY', 'victim', 'units', 'Line - Low price'), ('LINE LARGE', 'victim', 'units', 'Line - By size'),
         ('LINE MEDIUM', 'victim', 'units', 'Line - By size'), ('LINE PROMO', 'victim', 'units', 'Line - Low price'),
         ('LINE SMALL', 'victim', 'units', 'Line - By size'), ('LINE STANDARD', 'victim', 'units', 'Plain line'),
         ('ORDER 1-URGENT', 'count', 'orders', 'Fast order'), ('ORDER 2-HIGH', 'count', 'orders', 'Fast order'),
         ('ORDER 3-MEDIUM', 'count', 'orders', 'Order - Medium'), ('ORDER 4-NOT SPECIFIED', 'count', 'orders', 'Order - Open'),
         ('ORDER 5-LOW', 'count', 'orders', 'Order - Low'), ('VALUE PRIORITY', 'weight', 'currency', 'Value'),
         ('VALUE STANDARD', 'weight', 'currency', 'Value')
),
placed AS (
  SELECT o_orderkey, o_orderpriority, o_totalprice, c_mktsegment, n_name AS state, c_name AS municipality,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_month, o_orderstatus AS jurisdiction,
         CAST(year(o_orderdate) AS BIGINT) AS source_year
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
raw AS (
  SELECT state, municipality, 'LINE ' || p_type AS indicator, ref_month,
         CASE WHEN p_type = 'SMALL' THEN c_mktsegment END AS agent,
         CASE WHEN p_type = 'PROMO' THEN l_linestatus END AS weapon,
         CASE WHEN p_type = 'ECONOMY' AND p_size <= 25 THEN 'S' WHEN p_type = 'ECONOMY' THEN 'L' END AS age_band,
         CAST(CASE WHEN l_returnflag = 'A' THEN l_quantity END AS DECIMAL(28,10)) AS female,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity END AS DECIMAL(28,10)) AS male,
         CAST(CASE WHEN l_returnflag = 'N' THEN l_quantity END AS DECIMAL(28,10)) AS unknown_sex,
         CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(28,10)) AS victim_total,
         CAST(NULL AS DECIMAL(28,10)) AS count_value, CAST(NULL AS DECIMAL(28,10)) AS weight_value,
         jurisdiction, source_year
  FROM lineitem JOIN placed ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  UNION ALL
  SELECT state, municipality, 'ORDER ' || o_orderpriority, ref_month, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END, NULL, jurisdiction, source_year
  FROM placed
  UNION ALL
  SELECT state, municipality,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'VALUE PRIORITY' ELSE 'VALUE STANDARD' END,
         ref_month, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(28,10)), jurisdiction, source_year
  FROM placed
),
staging AS (
  SELECT state, municipality, indicator, ref_month, agent, weapon, age_band, female, male, unknown_sex,
         count_value, weight_value, jurisdiction, source_year FROM raw
),
grain AS (
  SELECT state, municipality, indicator, ref_month, jurisdiction, agent, weapon, age_band, source_year,
         CAST(SUM(female) AS DECIMAL(24,10)) AS female, CAST(SUM(male) AS DECIMAL(24,10)) AS male,
         CAST(SUM(unknown_sex) AS DECIMAL(24,10)) AS unknown_sex,
         CAST(SUM(count_value) AS DECIMAL(24,10)) AS count_value, CAST(SUM(weight_value) AS DECIMAL(24,10)) AS weight_value
  FROM staging GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
),
dim_time AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY ref_month) AS BIGINT) AS time_id, ref_month,
         CAST(year(ref_month) AS BIGINT) AS year, CAST(month(ref_month) AS BIGINT) AS month,
         CAST(quarter(ref_month) AS BIGINT) AS quarter, strftime(ref_month, '%B') AS month_name,
         COUNT(*) OVER (PARTITION BY year(ref_month)) < 12 AS is_partial_year
  FROM (SELECT DISTINCT ref_month FROM staging)
),
dim_place AS (
  SELECT ROW_NUMBER() OVER (ORDER BY state, municipality) AS place_id, state, municipality, r_name AS region
  FROM (SELECT DISTINCT state, municipality FROM staging)
  JOIN nation ON n_name = state JOIN region ON n_regionkey = r_regionkey
),
dim_indicator AS (
  SELECT ROW_NUMBER() OVER (ORDER BY indicator) AS indicator_id, indicator, family, unit, kind,
         CASE WHEN kind LIKE 'Line%' THEN 'Lines' WHEN kind = 'Fast order' THEN 'Fast orders'
              WHEN kind LIKE 'Order%' THEN 'Orders' WHEN kind = 'Value' THEN 'Values' ELSE 'Other' END AS semantic_group
  FROM classified
),
dim_jurisdiction AS (
  SELECT ROW_NUMBER() OVER (ORDER BY jurisdiction) AS jurisdiction_id, jurisdiction
  FROM (SELECT DISTINCT jurisdiction FROM staging WHERE jurisdiction IS NOT NULL)
),
dim_agent AS (
  SELECT ROW_NUMBER() OVER (ORDER BY agent) AS agent_id, agent
  FROM (SELECT DISTINCT agent FROM staging WHERE agent IS NOT NULL)
),
dim_weapon AS (
  SELECT ROW_NUMBER() OVER (ORDER BY weapon) AS weapon_id, weapon
  FROM (SELECT DISTINCT weapon FROM staging WHERE weapon IS NOT NULL)
),
dim_age_band AS (
  SELECT ROW_NUMBER() OVER (ORDER BY age_band) AS age_band_id, age_band
  FROM (SELECT DISTINCT age_band FROM staging WHERE age_band IS NOT NULL)
),
dim_sex(sex_id, sex) AS (
  VALUES (CAST(1 AS BIGINT), 'Feminino'), (CAST(2 AS BIGINT), 'Masculino'), (CAST(3 AS BIGINT), 'Não Informado')
),
long AS (
  SELECT g.*, 'Feminino' AS sex, female AS value FROM grain g WHERE female IS NOT NULL
  UNION ALL SELECT g.*, 'Masculino', male FROM grain g WHERE male IS NOT NULL
  UNION ALL SELECT g.*, 'Não Informado', unknown_sex FROM grain g WHERE unknown_sex IS NOT NULL
  UNION ALL SELECT g.*, NULL, count_value FROM grain g WHERE count_value IS NOT NULL
  UNION ALL SELECT g.*, NULL, weight_value FROM grain g WHERE weight_value IS NOT NULL
),
labelled AS (
  SELECT t.*, p.place_id, p.state, p.municipality, p.region,
         i.indicator_id, i.indicator, i.family, i.unit, i.kind, i.semantic_group,
         j.jurisdiction_id, j.jurisdiction, a.agent_id, a.agent, w.weapon_id, w.weapon,
         b.age_band_id, b.age_band, s.sex_id, s.sex, CAST(l.value AS DECIMAL(24,10)) AS value, l.source_year
  FROM long l
  JOIN dim_time t ON t.ref_month = l.ref_month
  JOIN dim_place p ON p.state = l.state AND p.municipality = l.municipality
  JOIN dim_indicator i ON i.indicator = l.indicator
  JOIN dim_jurisdiction j ON j.jurisdiction = l.jurisdiction
  LEFT JOIN dim_agent a ON a.agent = l.agent
  LEFT JOIN dim_weapon w ON w.weapon = l.weapon
  LEFT JOIN dim_age_band b ON b.age_band = l.age_band
  LEFT JOIN dim_sex s ON s.sex = l.sex
),
series AS (
  SELECT indicator, family, unit, semantic_group, ref_month, year, month, quarter, month_name, is_partial_year,
         SUM(value) AS total
  FROM labelled GROUP BY ALL
),
cutoff AS (
  SELECT COALESCE(MIN(last_month), 12) AS cutoff_month
  FROM (SELECT year, MAX(month) AS last_month FROM dim_time WHERE is_partial_year GROUP BY year)
),
cells AS (
  SELECT indicator, 'victim' AS needs, female AS cell FROM grain UNION ALL
  SELECT indicator, 'victim', male FROM grain UNION ALL SELECT indicator, 'victim', unknown_sex FROM grain UNION ALL
  SELECT indicator, 'count', count_value FROM grain UNION ALL SELECT indicator, 'weight', weight_value FROM grain
),
missing AS (
  SELECT known.indicator, known.family, sizes.grain_rows, COUNT(*) AS applicable_cells, COUNT(*) - COUNT(cells.cell) AS missing_cells
  FROM dim_indicator AS known
  JOIN cells ON cells.indicator = known.indicator AND cells.needs = known.family
  JOIN (SELECT indicator, COUNT(*) AS grain_rows FROM grain GROUP BY indicator) AS sizes ON sizes.indicator = known.indicator
  GROUP BY known.indicator, known.family, sizes.grain_rows
),
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY indicator ORDER BY ref_month) AS step FROM series
),
metrics AS (
  SELECT now.* EXCLUDE (step), (SELECT MAX(old.total) FROM numbered AS old WHERE old.indicator = now.indicator AND old.step = now.step - 1) AS previous_month,
         (SELECT MAX(old.total) FROM numbered AS old WHERE old.indicator = now.indicator AND old.step = now.step - 12) AS same_month_last_year,
         (SELECT CAST(SUM(old.total) AS DOUBLE) / COUNT(*) FROM numbered AS old
          WHERE old.indicator = now.indicator AND old.step BETWEEN now.step - 2 AND now.step) AS moving_mean_3
  FROM numbered AS now
),
centred AS (
  SELECT *, CAST(total AS DOUBLE) - AVG(CAST(total AS DOUBLE)) OVER whole AS apart, COUNT(*) OVER whole AS months,
         CAST(SUM(total) OVER whole AS DOUBLE) AS overall
  FROM series WINDOW whole AS (PARTITION BY indicator)
),
deviations AS (
  SELECT * EXCLUDE (apart, months, overall), overall / months AS historical_mean, SQRT(SUM(apart * apart) OVER (PARTITION BY indicator) / months) AS historical_deviation,
         ROUND(apart / NULLIF(SQRT(SUM(apart * apart) OVER (PARTITION BY indicator) / months), 0), 6) + CAST(0 AS DOUBLE) AS z_score
  FROM centred
)
"""
