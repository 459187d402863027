"""Independent DuckDB SQL for every registered query.

Written from the analysis definitions, not generated from the Spark plans.
Each query starts from the same ``products`` view over the driver tables
(FIXTURES.md section 2) and spells out what DuckDB and Spark would otherwise
do differently: null order, tie-breaks, sum types, half-even rounding (exact,
on integers), and null-safe equality.
"""

from __future__ import annotations

from vitrine.plans import params as P

PRODUCTS_CTE = """p AS (
  SELECT
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
    pt.p_type AS type,
    pt.p_name AS name,
    pt.p_name AS keywords,
    CASE l.l_returnflag WHEN 'N' THEN 'Women' WHEN 'A' THEN 'Men' WHEN 'R' THEN 'Unisex' END AS gender_target,
    c.c_mktsegment AS category,
    'Q' || CAST(quarter(l.l_shipdate) AS VARCHAR) AS season,
    o.o_orderpriority AS condition,
    CAST(l.l_quantity AS DECIMAL(18,6)) AS like_count,
    CASE WHEN l.l_partkey % 53 <> 0 THEN split_part(pt.p_name, ' ', 2) END AS material,
    split_part(pt.p_name, ' ', 1) AS color,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.9973 AS DECIMAL(18,6)) AS price_usd,
    pt.p_brand AS brand_name,
    l.l_linestatus = 'F' AS sold,
    l.l_returnflag = 'R' AS reserved,
    l.l_linestatus = 'O' AS available,
    CASE WHEN l.l_suppkey % 31 <> 0 THEN CAST(l.l_suppkey AS VARCHAR) END AS seller_id,
    s.s_name AS username,
    sn.n_name AS country,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.9973 AS DECIMAL(18,6)) AS seller_price,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,6)) AS earning,
    (l.l_suppkey * 13) % 100 AS products_sold,
    (l.l_suppkey * 37) % 200 AS num_products_listed,
    CAST(greatest(s.s_acctbal, 0) AS DECIMAL(18,6)) AS num_followers,
    CAST(60 + l.l_suppkey % 41 AS DOUBLE) AS pass_rate,
    CASE WHEN l.l_suppkey % 23 = 0 THEN NULL WHEN s.s_acctbal >= 4000 THEN 'Expert' WHEN s.s_acctbal >= 1500 THEN 'Trusted' ELSE 'Regular' END AS badge,
    CASE WHEN l.l_tax <> 0 THEN CAST(CAST(l.l_tax AS DECIMAL(18,2)) * 31.7 AS DECIMAL(18,6)) END AS buyers_fees,
    r.r_name AS warehouse_name
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation cn ON cn.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = cn.n_regionkey
  JOIN part pt ON pt.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation sn ON sn.n_nationkey = s.s_nationkey
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([PRODUCTS_CTE, *ctes]) + "\n"


def half_even_units(num: str, den: str, scale: int = 2) -> str:
    """SQL: round_half_even(num / den * 10**scale) as an exact HUGEINT.
    ``num`` has at most six decimal places, ``den`` is an integer."""
    n = f"CAST(CAST(({num}) AS DECIMAL(30,6)) * 1000000 AS HUGEINT)"
    d = f"(CAST(({den}) AS HUGEINT) * {10**(6 - scale)})"
    q = f"(abs({n}) // abs({d}))"
    r = f"(abs({n}) % abs({d}))"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * ({q} + "
        f"CASE WHEN 2 * {r} > abs({d}) THEN 1 WHEN 2 * {r} = abs({d}) THEN {q} % 2 ELSE 0 END) END)"
    )


def half_even(num: str, den: str, scale: int = 2) -> str:
    return f"(CAST({half_even_units(num, den, scale)} AS DOUBLE) / {float(10**scale)})"


def money(x: str) -> str:
    """SQL: a price as reported, rounded half to even at two places."""
    return half_even(x, "1")


def units_text(q: str) -> str:
    """SQL: non-negative hundredths as the shortest decimal text."""
    return (
        f"(CAST({q} // 100 AS VARCHAR) || CASE WHEN {q} % 100 = 0 THEN '' "
        f"WHEN {q} % 10 = 0 THEN '.' || CAST(({q} % 100) // 10 AS VARCHAR) "
        f"ELSE '.' || lpad(CAST({q} % 100 AS VARCHAR), 2, '0') END)"
    )


def mean(total: str, count: str) -> str:
    return f"(CASE WHEN {count} <> 0 THEN CAST({total} AS DOUBLE) / CAST({count} AS DOUBLE) END)"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ci(pattern: str) -> str:
    return _lit(pattern if pattern.startswith("(?i)") else "(?i)" + pattern)


def nse(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in cols)


# ------------------------------------------------------------------ analyses
def t1() -> str:
    return _with(
        f"""s AS (SELECT seller_id, min(username) AS username, CAST(max(num_followers) AS DOUBLE) AS num_followers
      FROM p WHERE category = {_lit(P.T1_CATEGORY)} AND badge = {_lit(P.T1_BADGE)} GROUP BY seller_id)""",
        """top AS (SELECT * FROM s ORDER BY num_followers DESC NULLS LAST, username ASC NULLS FIRST,
      seller_id ASC NULLS FIRST LIMIT 1)""",
    ) + """SELECT t.username, t.num_followers, p.brand_name AS brand, count(*) AS total_sold
FROM p JOIN top t ON p.seller_id IS NOT DISTINCT FROM t.seller_id
GROUP BY t.username, t.num_followers, p.brand_name
ORDER BY total_sold DESC, brand ASC NULLS FIRST LIMIT 5"""


def t2() -> str:
    return _with(
        f"""ps AS (SELECT brand_name AS brand, seller_id, coalesce(sum(earning), 0) AS total FROM p
      WHERE price_usd <= {P.T2_MAX_PRICE} AND (num_products_listed >= {P.T2_MIN_LISTED} OR products_sold >= {P.T2_MIN_SOLD})
      GROUP BY brand_name, seller_id)""",
        "pb AS (SELECT brand, sum(total) AS s, count(total) AS n FROM ps GROUP BY brand)",
    ) + f"""SELECT brand, {half_even('s', 'n')} AS average_earnings FROM pb
ORDER BY average_earnings DESC NULLS LAST, brand ASC NULLS FIRST LIMIT 10"""


_SELLER_PROFILES = """sp AS (SELECT seller_id, min(username) AS seller_username, max(products_sold) AS products_sold,
      min(badge) AS badge FROM p GROUP BY seller_id)"""

_BADGE_TOP = """bt AS (SELECT badge, CAST(rn AS BIGINT) AS seller_rank, seller_username, products_sold FROM (
      SELECT *, row_number() OVER (PARTITION BY badge ORDER BY products_sold DESC NULLS LAST,
        seller_username ASC NULLS FIRST, seller_id ASC NULLS FIRST) AS rn FROM sp) WHERE rn <= 3)"""

_BADGE_EARN = f"""be AS (SELECT badge, {money('mn')} AS min_earnings, {money('mx')} AS max_earnings,
      {half_even('s', 'n')} AS avg_earnings, cnt AS count FROM (
      SELECT badge, min(earning) AS mn, max(earning) AS mx, sum(earning) AS s, count(earning) AS n, count(*) AS cnt
      FROM p GROUP BY badge) pb
      WHERE EXISTS (SELECT 1 FROM sp WHERE sp.badge IS NOT DISTINCT FROM pb.badge))"""


def t3_top() -> str:
    return _with(_SELLER_PROFILES, _BADGE_TOP) + "SELECT * FROM bt"


def t3_earn() -> str:
    return _with(_SELLER_PROFILES, _BADGE_EARN) + "SELECT * FROM be"


def t3_report() -> str:
    return _with(_SELLER_PROFILES, _BADGE_TOP, _BADGE_EARN) + (
        "SELECT be.*, bt.seller_rank, bt.seller_username, bt.products_sold FROM be "
        "JOIN bt ON be.badge IS NOT DISTINCT FROM bt.badge"
    )


def t4() -> str:
    return _with(
        """g AS (SELECT country, seller_id, min(username) AS username, coalesce(sum(earning), 0) AS earn,
      coalesce(sum(like_count), 0) AS likes, min(num_followers) AS followers, count(*) AS products
      FROM p GROUP BY country, seller_id)""",
        """h AS (SELECT country, seller_id, username, CAST(earn AS DOUBLE) AS total_earnings,
      CAST(likes AS DOUBLE) / CAST(products AS DOUBLE) AS avg_likes_per_product,
      CASE WHEN followers = 0 THEN 0.0
           ELSE CAST(likes AS DOUBLE) / CAST(products AS DOUBLE) / CAST(followers AS DOUBLE) * 100.0 END
        AS likes_to_followers_ratio FROM g)""",
    ) + """SELECT country, username, total_earnings, avg_likes_per_product, likes_to_followers_ratio,
  CAST(row_number() OVER (PARTITION BY country ORDER BY total_earnings DESC NULLS LAST,
    username ASC NULLS FIRST, seller_id ASC NULLS FIRST) AS BIGINT) AS rank FROM h"""


def t5() -> str:
    countries = ", ".join(_lit(x) for x in P.T5_COUNTRIES)
    return _with(
        f"""g AS (SELECT material, username AS seller, sum(seller_price) AS s, count(seller_price) AS n,
      CAST(max(pass_rate) AS DOUBLE) AS pass_rate, min(country) AS seller_country
      FROM p WHERE country IN ({countries}) AND pass_rate > {P.T5_MIN_PASS_RATE} GROUP BY material, username)""",
        f"""r AS (SELECT *, row_number() OVER (PARTITION BY material ORDER BY {mean('s', 'n')} ASC NULLS FIRST,
      seller ASC NULLS FIRST) AS rn FROM g)""",
    ) + f"""SELECT material, seller, {mean('s', 'n')} AS avg_price, pass_rate, seller_country, CAST(rn AS BIGINT) AS rank
FROM r WHERE rn <= 3"""


def j1(max_price=None) -> str:
    cap = f" AND price_usd <= {max_price}" if max_price is not None else ""
    return _with(
        f"""bc AS (SELECT season, material, color, count(*) AS n, sum(price_usd) AS s, min(price_usd) AS mn,
      max(price_usd) AS mx FROM p
      WHERE gender_target = {_lit(P.J1_GENDER)} AND regexp_matches(name, {_ci(P.J1_PATTERN)})
        AND price_usd IS NOT NULL{cap}
      GROUP BY season, material, color)""",
        """mc AS (SELECT season, material, color, row_number() OVER (PARTITION BY season, material
      ORDER BY n DESC, color ASC NULLS FIRST) AS rn FROM bc)""",
        """g AS (SELECT season, material, sum(n) AS n, sum(s) AS s, min(mn) AS mn, max(mx) AS mx FROM bc
      GROUP BY season, material)""",
    ) + f"""SELECT g.season || ' - ' || g.material AS season_material, mc.color AS most_common_color,
  {half_even('g.s', 'g.n')} AS average_price, {money('g.mn')} AS min_price, {money('g.mx')} AS max_price
FROM g JOIN mc ON {nse('g', 'mc', ['season', 'material'])} AND mc.rn = 1
ORDER BY {mean('g.s', 'g.n')} DESC NULLS LAST, g.season ASC NULLS FIRST, g.material ASC NULLS FIRST LIMIT 30"""


def j2() -> str:
    return _with(
        "g AS (SELECT category, type, coalesce(sum(num_followers), 0) AS t FROM p GROUP BY category, type)",
        """r AS (SELECT category, type, row_number() OVER (PARTITION BY category ORDER BY t DESC NULLS LAST,
      type ASC NULLS FIRST) AS rn FROM g)""",
        "tot AS (SELECT category, sum(t) AS total FROM g GROUP BY category)",
    ) + f"""SELECT tot.category, CAST(tot.total AS DOUBLE) AS total_followers, r.type AS most_popular_type
FROM tot JOIN r ON {nse('tot', 'r', ['category'])} AND r.rn = 1
ORDER BY total_followers DESC NULLS LAST, tot.category ASC NULLS FIRST"""


def j3() -> str:
    return _with(
        """g AS (SELECT season, category, count_if(sold) AS s, count_if(NOT sold) AS u FROM p
      GROUP BY season, category)""",
        """lc AS (SELECT season, category, row_number() OVER (PARTITION BY season ORDER BY u DESC,
      category ASC NULLS FIRST) AS rn FROM g WHERE u > 0)""",
        "t AS (SELECT season, CAST(sum(s) AS BIGINT) AS ts, CAST(sum(u) AS BIGINT) AS tu FROM g GROUP BY season)",
        f"""q AS (SELECT t.*, ts + tu AS tp,
      CASE WHEN ts + tu > 0 THEN {half_even_units('ts * 100', 'ts + tu')} ELSE 0 END AS q FROM t)""",
    ) + f"""SELECT q.season, ts AS total_sold, tu AS total_not_sold, tp AS total_products,
  CAST(q.q AS DOUBLE) / 100.0 AS percentage_sold, {units_text('q.q')} || '%' AS percentage_sold_string,
  lc.category AS least_sold_category
FROM q LEFT JOIN lc ON {nse('q', 'lc', ['season'])} AND lc.rn = 1
ORDER BY percentage_sold DESC NULLS LAST, q.season ASC NULLS FIRST"""


def j4(split: bool = False) -> str:
    if split:
        kw = (
            f"kw AS (SELECT condition, keyword, material FROM (SELECT condition, material, "
            f"unnest(string_split(keywords, {_lit(P.J4_SEPARATOR)})) AS keyword FROM liked) WHERE keyword <> '')"
        )
    else:
        kw = "kw AS (SELECT condition, keywords AS keyword, material FROM liked WHERE keywords IS NOT NULL)"
    return _with(
        "st AS (SELECT sum(like_count) AS s, count(like_count) AS n FROM p)",
        "liked AS (SELECT p.* FROM p, st WHERE p.like_count * st.n > st.s)",
        kw,
        "bm AS (SELECT condition, keyword, material, count(*) AS n FROM kw GROUP BY condition, keyword, material)",
        """tm AS (SELECT condition, keyword, material, row_number() OVER (PARTITION BY condition, keyword
      ORDER BY n DESC, material ASC NULLS FIRST) AS rn FROM bm)""",
        "bk AS (SELECT condition, keyword, sum(n) AS cnt FROM bm GROUP BY condition, keyword)",
        f"""j AS (SELECT bk.condition, bk.keyword, tm.material AS top_material, bk.cnt FROM bk
      JOIN tm ON {nse('bk', 'tm', ['condition', 'keyword'])} AND tm.rn = 1)""",
        """r AS (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY cnt DESC, keyword ASC NULLS FIRST) AS rn
      FROM j)""",
    ) + """SELECT condition, keyword AS top_keyword, top_material, CAST(cnt AS BIGINT) AS count FROM r WHERE rn = 1
ORDER BY condition ASC NULLS FIRST"""


def _j5_ctes() -> list[str]:
    k1, k2 = _ci(P.J5_KINDS[0]), _ci(P.J5_KINDS[1])
    base = f"""base AS (SELECT * FROM p WHERE gender_target = {_lit(P.J5_GENDER)} AND color = {_lit(P.J5_COLOR)}
      AND price_usd IS NOT NULL)"""

    def one(name: str, kind: str, direction: str) -> str:
        return (
            f"{name} AS (SELECT name, price_usd, material FROM base WHERE regexp_matches(name, {kind}) "
            f"ORDER BY price_usd {direction}, name ASC NULLS FIRST, material ASC NULLS FIRST LIMIT 1)"
        )

    def cents(name: str) -> str:
        return f"coalesce((SELECT {half_even_units('price_usd', '1')} FROM {name}), 0)"

    # In hundredths: the prices as reported, added.
    tot = f"tot AS (SELECT {cents('c1')} + {cents('c2')} AS lo, {cents('d1')} + {cents('d2')} AS hi)"
    return [base, one("c1", k1, "ASC"), one("c2", k2, "ASC"), one("d1", k1, "DESC"), one("d2", k2, "DESC"), tot]


def j5_extremes() -> str:
    k1, k2 = P.J5_KINDS
    l1, l2 = P.J5_LABELS
    col = _lit(P.J5_COLOR)

    def item(slot: str, label: str, src: str, mat: bool) -> str:
        m = f"(SELECT material FROM {src})" if mat else "CAST(NULL AS VARCHAR)"
        return (
            f"SELECT {_lit(slot)} AS slot, {_lit(label)} AS type, {col} AS color, (SELECT name FROM {src}) AS product_name, "
            f"(SELECT {money('price_usd')} FROM {src}) AS product_price, {m} AS material"
        )

    items = " UNION ALL ".join([
        item(f"cheapest_{k1}", l1, "c1", True),
        item(f"cheapest_{k2}", l2, "c2", False),
        item(f"most_expensive_{k1}", l1, "d1", True),
        item(f"most_expensive_{k2}", l2, "d2", False),
    ])
    return _with(*_j5_ctes()) + (
        "SELECT it.*, CAST(tot.lo AS DOUBLE) / 100.0 AS cheapest_total, CAST(tot.hi AS DOUBLE) / 100.0 AS most_expensive_total "
        f"FROM ({items}) it, tot"
    )


def j5_range(limit: int | None = 10) -> str:
    lim = f" ORDER BY product_price ASC, product_name ASC NULLS FIRST, product_gender ASC NULLS FIRST LIMIT {limit}" if limit else ""
    return _with(*_j5_ctes()) + (
        f"SELECT name AS product_name, {money('price_usd')} AS product_price, color AS product_color, "
        "gender_target AS product_gender, material AS product_material FROM p "
        f"WHERE price_usd * 100 > (SELECT lo FROM tot) AND price_usd * 100 < (SELECT hi FROM tot) AND color = {_lit(P.J5_COLOR)} "
        f"AND material IS NOT DISTINCT FROM (SELECT material FROM d1){lim}"
    )


def m1() -> str:
    return _with(
        "tc AS (SELECT condition, type AS product_type, color, count(*) AS color_count FROM p GROUP BY condition, type, color)",
        "ty AS (SELECT condition, product_type, CAST(sum(color_count) AS BIGINT) AS count FROM tc GROUP BY condition, product_type)",
        """tt AS (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY count DESC, product_type ASC NULLS FIRST) AS rn
      FROM ty)""",
        """tcr AS (SELECT *, row_number() OVER (PARTITION BY condition, product_type ORDER BY color_count DESC,
      color ASC NULLS FIRST) AS rn FROM tc)""",
    ) + f"""SELECT tt.condition, tt.product_type, tt.count, tcr.color, tcr.color_count
FROM tt JOIN tcr ON {nse('tt', 'tcr', ['condition', 'product_type'])} WHERE tt.rn <= 2 AND tcr.rn <= 2"""


def m2() -> str:
    return _with(
        """g AS (SELECT season, material, count(*) AS count, coalesce(sum(price_usd), 0) AS total FROM p
      GROUP BY season, material)""",
        """t AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY count DESC, material ASC NULLS FIRST) AS rn
      FROM g)""",
        f"top AS (SELECT season, material, count, {mean('total', 'count')} AS avg_price_usd FROM t WHERE rn <= 5)",
        "lst AS (SELECT season, list_sort(list({'m': material, 'v': avg_price_usd, 'count': count})) AS g FROM top GROUP BY season)",
        f"""f AS (SELECT top.*, list_transform(list_filter(lst.g, lambda x: x.m IS DISTINCT FROM top.material
      AND x.v IS NOT NULL), lambda x: x.v) AS o FROM top JOIN lst ON {nse('top', 'lst', ['season'])})""",
        """h AS (SELECT season, material, count, avg_price_usd,
      CASE WHEN len(o) > 0 THEN list_reduce(list_prepend(CAST(0.0 AS DOUBLE), o), lambda a, b: a + b) / len(o) END
        AS avg_of_other FROM f)""",
    ) + "SELECT *, avg_price_usd - avg_of_other AS difference FROM h"


def m3() -> str:
    return _with(
        """g AS (SELECT country AS country_name, brand_name AS brand, coalesce(sum(earning), 0) AS e, count(*) AS n
      FROM p GROUP BY country, brand_name)""",
        """r AS (SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY n DESC, brand ASC NULLS FIRST) AS rn
      FROM g)""",
        "t AS (SELECT country_name, sum(e) AS total FROM g GROUP BY country_name)",
    ) + f"""SELECT r.country_name, r.brand AS max_brand_name_for_country, r.n AS max_brand_count_for_country,
  CAST(r.e AS DOUBLE) AS total_seller_earnings_country_max_brand_count_for_country,
  CAST(t.total - r.e AS DOUBLE) AS total_seller_earnings_country_all_other_brands
FROM r JOIN t ON {nse('r', 't', ['country_name'])} WHERE r.rn = 1"""


_M4 = [
    "f AS (SELECT * FROM p WHERE buyers_fees IS NOT NULL)",
    f"""w AS (SELECT warehouse_name, CAST(count_if(sold) AS BIGINT) AS total_sold,
      CAST(count_if(reserved) AS BIGINT) AS total_reserved, CAST(count_if(available) AS BIGINT) AS total_available,
      {mean('sum(buyers_fees)', 'count(buyers_fees)')} AS avg_buyers_fees FROM f GROUP BY warehouse_name)""",
    f"""co AS (SELECT country, {mean('sum(buyers_fees)', 'count(buyers_fees)')} AS avg_buyers_fees_country
      FROM f GROUP BY country)""",
    """pairs AS (SELECT w.*, co.country, co.avg_buyers_fees_country FROM w
      JOIN co ON co.avg_buyers_fees_country < w.avg_buyers_fees)""",
    f"""ty AS (SELECT country, type, {mean('sum(buyers_fees)', 'count(buyers_fees)')} AS type_avg_buyers_fees
      FROM f GROUP BY country, type)""",
    f"""nr AS (SELECT ty.country, ty.type, ty.type_avg_buyers_fees,
      abs(ty.type_avg_buyers_fees - co.avg_buyers_fees_country) AS diff,
      row_number() OVER (PARTITION BY ty.country ORDER BY abs(ty.type_avg_buyers_fees - co.avg_buyers_fees_country)
        ASC NULLS FIRST, ty.type ASC NULLS FIRST) AS rn
      FROM ty JOIN co ON {nse('ty', 'co', ['country'])})""",
]


def m4_counts() -> str:
    return _with(*_M4) + "SELECT * FROM w"


def m4_pairs() -> str:
    return _with(*_M4) + "SELECT * FROM pairs"


def m4_nearest() -> str:
    return _with(*_M4) + f"""SELECT pairs.warehouse_name, pairs.total_sold, pairs.total_reserved, pairs.total_available,
  pairs.avg_buyers_fees, pairs.country, pairs.avg_buyers_fees_country, nr.type, nr.type_avg_buyers_fees, nr.diff
FROM pairs JOIN nr ON {nse('pairs', 'nr', ['country'])} AND nr.rn <= 2"""


_M5 = [
    "v AS (SELECT price_usd, name, type FROM p WHERE price_usd IS NOT NULL)",
    "nn AS (SELECT count(*) AS n, min(price_usd) AS mn, max(price_usd) AS mx FROM v)",
    "rk AS (SELECT price_usd, row_number() OVER (ORDER BY price_usd) - 1 AS idx FROM v)",
    """cuts AS (SELECT max(CASE WHEN idx = floor(nn.n * 0.25) THEN price_usd END) AS q1,
      max(CASE WHEN idx = floor(nn.n * 0.5) THEN price_usd END) AS q2,
      max(CASE WHEN idx = floor(nn.n * 0.75) THEN price_usd END) AS q3 FROM rk, nn)""",
    f"""bands AS (SELECT CASE WHEN price_usd < q1 THEN 'min_q1' WHEN price_usd < q2 THEN 'q1_median'
      WHEN price_usd < q3 THEN 'median_q3' ELSE 'q3_max' END AS band, name, type,
      {money('price_usd')} AS price_usd FROM v, cuts)""",
]


def m5_cuts() -> str:
    return _with(*_M5) + (
        f"SELECT nn.n, {money('nn.mn')} AS min_q1, {money('q1')} AS q1_median, "
        f"{money('q2')} AS median_q3, {money('q3')} AS q3_max, {money('nn.mx')} AS max_price FROM nn, cuts"
    )


def m5_bands() -> str:
    return _with(*_M5) + "SELECT * FROM bands"


def m5_band_counts() -> str:
    return _with(*_M5) + (
        "SELECT band, count(*) AS count, min(price_usd) AS lower, max(price_usd) AS upper FROM bands GROUP BY band"
    )


def analysis_sql() -> dict[str, str]:
    return {
        "top_seller_brands": t1(),
        "brand_avg_seller_earnings": t2(),
        "badge_top_sellers": t3_top(),
        "badge_earnings": t3_earn(),
        "badge_report": t3_report(),
        "country_seller_ranking": t4(),
        "cheapest_sellers_by_material": t5(),
        "season_material_price_profile": j1(),
        "season_material_price_profile_capped": j1(P.J1_MAX_PRICE),
        "category_popularity": j2(),
        "season_sell_through": j3(),
        "popular_keywords_by_condition": j4(False),
        "popular_keywords_split": j4(True),
        "outfit_extremes": j5_extremes(),
        "outfit_range_listings": j5_range(10),
        "top_types_and_colors": m1(),
        "season_material_leave_one_out": m2(),
        "country_lead_brand": m3(),
        "warehouse_state_counts": m4_counts(),
        "warehouse_cheaper_countries": m4_pairs(),
        "warehouse_nearest_types": m4_nearest(),
        "price_quartile_cuts": m5_cuts(),
        "country_seller_ranking_distributed": t4(),
        "price_quartile_cuts_narrowed": m5_cuts(),
        "price_quartile_band_counts": m5_band_counts(),
        "price_quartile_bands": m5_bands(),
    }
