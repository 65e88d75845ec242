"""For each registered query, independent SQL over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

DIMENSIONS = ("ProductCategory", "ProductSubcategory", "Country", "IncomeGroup", "Occupation", "TerritoryGroup")

AMOUNT = "cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,2))"
COST = (
    "cast(cast(l_quantity as decimal(10,2)) * cast(p_retailprice as decimal(10,2))"
    " * cast(1.25 as decimal(4,2)) as decimal(18,2))"
)
INCOME = (
    "case when cast(c_acctbal as decimal(18,2)) < 2500 then 'Low Income'"
    " when cast(c_acctbal as decimal(18,2)) < 6000 then 'Middle Income' else 'High Income' end"
)


def r(expression: str, digits: int = 6) -> str:
    return f"round(cast({expression} as double), {digits})"


def ratio(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def change(a: str, b: str) -> str:
    return ratio(f"({a} - {b})", b)


SALES = f"""
lines as (
  select l.*, o.o_orderkey, o.o_custkey, cast(o.o_orderdate as date) as odate, p.p_type, p.p_brand, p.p_retailprice,
    c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, g.r_name, {AMOUNT} as amount, {COST} as cost
  from lineitem l left join part p on l.l_partkey = p.p_partkey left join orders o on l.l_orderkey = o.o_orderkey
    left join customer c on o.o_custkey = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey
    left join region g on n.n_regionkey = g.r_regionkey),
s as (
  select cast(year(odate) as bigint) as CalendarYear,
    cast(year(odate) * 100 + month(odate) as bigint) as YearMonthNumber,
    'Q' || cast(quarter(odate) as varchar) as QuarterLabel, strftime(odate, '%b %Y') as MonthYear,
    r_name as TerritoryGroup, n_name as Country, p_type as ProductCategory, p_brand as ProductSubcategory,
    {INCOME} as IncomeGroup, c_mktsegment as Occupation, amount as Revenue, amount - cost as Profit,
    cast(l_quantity as bigint) as UnitsSold, cast(l_orderkey as varchar) as SalesOrderNumber,
    cast(o_custkey as varchar) as CustomerKey
  from lines)"""

CALENDAR = """
days as (
  select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d
  from (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders)),
cal as (
  select cast(year(d) * 10000 + month(d) * 100 + day(d) as bigint) as DateKey, d as FullDate,
    cast(year(d) as bigint) as CalendarYear, cast(case when month(d) <= 6 then 1 else 2 end as bigint) as CalendarSemester,
    cast(quarter(d) as bigint) as CalendarQuarter, 'Q' || cast(quarter(d) as varchar) as QuarterLabel,
    cast(month(d) as bigint) as MonthNumberOfYear, strftime(d, '%B') as MonthName, strftime(d, '%b %Y') as MonthYear,
    cast(year(d) * 100 + month(d) as bigint) as YearMonthNumber, cast(week(d) as bigint) as WeekNumberOfYear,
    cast(dayofyear(d) as bigint) as DayNumberOfYear, cast(day(d) as bigint) as DayNumberOfMonth,
    cast(isodow(d) as bigint) as DayNumberOfWeek, strftime(d, '%A') as DayName
  from days)"""

SUMS = "sum(Revenue) as Revenue, sum(Profit) as Profit, sum(UnitsSold) as UnitsSold"
COUNTS = "count(distinct SalesOrderNumber) as Orders, count(distinct CustomerKey) as Customers"


def per_dimension(select: str, group: str = "") -> str:
    """The same grouping written out once per dimension."""
    return " union all ".join(
        f"select '{d}' as dimension, {d} as segment{', ' + group if group else ''}, {select} from s"
        f" group by {d}{', ' + group if group else ''}"
        for d in DIMENSIONS
    )


SEGMENTS = f"""
seg as ({per_dimension(f"{SUMS}, {COUNTS}")}),
segk as (
  select *, {ratio("Profit", "Revenue")} as MarginPct, {ratio("Revenue", "Orders")} as AOV,
    {ratio("Revenue", "Customers")} as RevPerCustomer,
    {ratio("Revenue", "sum(Revenue) over (partition by dimension)")} as RevenueShare
  from seg)"""

YEARS = """
months as (
  select CalendarYear, count(distinct YearMonthNumber) as Months, sum(Revenue) as Revenue from s
  where CalendarYear is not null group by CalendarYear),
pair as (
  select max(a.CalendarYear) as ly, max(a.CalendarYear) - 1 as py from months a
  join months b on b.CalendarYear = a.CalendarYear - 1 where a.Months = 12 and b.Months = 12)"""


def yoy_tables(base_ratio: str = "0.05", name: str = "yoy") -> str:
    return f"""
{name}_j as (
  select c.*, p.Revenue as RevenueLY, p.Profit as ProfitLY, p.UnitsSold as UnitsSoldLY, p.Orders as OrdersLY,
    p.Customers as CustomersLY, {ratio("c.Profit", "c.Revenue")} as MarginPct, {ratio("c.Revenue", "c.Orders")} as AOV,
    {ratio("c.Revenue", "c.Customers")} as RevPerCustomer, {ratio("p.Profit", "p.Revenue")} as MarginPctLY,
    {ratio("c.Revenue", "sum(c.Revenue) over (partition by c.dimension)")} as RevenueShare,
    p.Revenue is null or coalesce(cast(p.Revenue as double) < cast({base_ratio} as double) * cast(c.Revenue as double),
      false) as IsNewBase
  from (select * exclude (CalendarYear) from segy, pair where CalendarYear = ly) c
  left join (select * from segy, pair where CalendarYear = py) p
    on p.dimension = c.dimension and p.segment is not distinct from c.segment),
{name}_g as (
  select * exclude (ly, py), MarginPct - MarginPctLY as MarginDelta,
    case when not IsNewBase then {change("Revenue", "RevenueLY")} end as RevenueYoY,
    case when not IsNewBase then {change("Profit", "ProfitLY")} end as ProfitYoY,
    case when not IsNewBase then {change("Orders", "OrdersLY")} end as OrdersYoY,
    case when not IsNewBase then {change("Customers", "CustomersLY")} end as CustomersYoY
  from {name}_j),
{name} as (
  select *, {growth_case("RevenueYoY")} as GrowthStatus, {margin_case("MarginPct")} as MarginStatus,
    case when IsNewBase then 'New in ' || (select ly from pair) else {signal_case("RevenueYoY", "MarginPct")} end
      as BusinessSignal,
    not IsNewBase and coalesce(RevenueYoY < -0.1::double, false) as RiskFlag,
    not IsNewBase and coalesce(RevenueYoY > 0.1::double and MarginPct >= 0.3::double, false) as OpportunityFlag
  from {name}_g)"""


def growth_case(g: str) -> str:
    return (
        f"case when {g} is null then 'No LY Data' when {g} > 0.1::double then 'Strong Growth' when {g} > 0 then"
        f" 'Moderate Growth' when {g} > -0.1::double then 'Moderate Decline' else 'Strong Decline' end"
    )


def margin_case(m: str) -> str:
    return (
        f"case when {m} is null then 'Unknown' when {m} >= 0.4::double then 'High Margin'"
        f" when {m} >= 0.25::double then 'Medium Margin' else 'Low Margin' end"
    )


def signal_case(g: str, m: str) -> str:
    return (
        f"case when {g} is null then 'No LY / New' when {g} > 0 and {m} >= 0.3::double then 'Growth Opportunity'"
        f" when {g} < 0 and {m} >= 0.3::double then 'Recover Priority'"
        f" when {g} > 0 and {m} < 0.2::double then 'Volume Growth, Low Margin'"
        f" when {g} < 0 and {m} < 0.2::double then 'High Risk' else 'Stable' end"
    )


SEGMENT_YEARS = f"segy as ({per_dimension(f'{SUMS}, {COUNTS}', 'CalendarYear')})"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


FACT = with_(SALES)
KPI = with_(SALES, SEGMENTS)
PERIOD = with_(SALES, YEARS)
YOY = with_(SALES, YEARS, SEGMENT_YEARS, yoy_tables())
LAUNCH = with_(SALES, YEARS, SEGMENT_YEARS, yoy_tables("0.95"))

MONEY = {"Revenue", "Profit", "RevenueLY", "ProfitLY", "RevenueLatest", "RevenuePrevious", "RevenuePrior"}
PLAIN = {
    "dimension", "segment", "rank", "UnitsSold", "Orders", "Customers", "UnitsSoldLY", "OrdersLY", "CustomersLY",
    "IsNewBase", "GrowthStatus", "MarginStatus", "BusinessSignal", "RiskFlag", "OpportunityFlag",
}


def col(name: str) -> str:
    if name in MONEY:
        return f"cast({name} as double) as {name}"
    if name in ("AOV", "RevPerCustomer"):
        return f"{r(name, 4)} as {name}"
    if name in ("UnitsSold", "UnitsSoldLY"):
        return f"cast({name} as bigint) as {name}"
    return name if name in PLAIN else f"{r(name)} as {name}"


def cols(*names: str) -> str:
    return ", ".join(col(n) for n in names)


KPI_COLUMNS = ("Revenue", "Profit", "UnitsSold", "Orders", "Customers", "MarginPct", "AOV", "RevPerCustomer")
SEGMENT_COLUMNS = ("dimension", "segment", *KPI_COLUMNS, "RevenueShare")
YOY_COLUMNS = (
    *SEGMENT_COLUMNS, "RevenueLY", "ProfitLY", "UnitsSoldLY", "OrdersLY", "CustomersLY", "MarginPctLY", "IsNewBase",
    "RevenueYoY", "ProfitYoY", "OrdersYoY", "CustomersYoY", "MarginDelta", "GrowthStatus", "MarginStatus",
    "BusinessSignal", "RiskFlag", "OpportunityFlag",
)
FIGURES = (
    "Revenue", "RevenueShare", "RevenueYoY", "ProfitYoY", "MarginPct", "MarginDelta", "OrdersYoY", "CustomersYoY",
)
RANKED_COLUMNS = ("dimension", "rank", "segment", *FIGURES, "BusinessSignal")
RAW_COLUMNS = """CalendarYear, YearMonthNumber, QuarterLabel, MonthYear, TerritoryGroup, Country, ProductCategory,
  ProductSubcategory, IncomeGroup, Occupation, cast(Revenue as double) as Revenue, cast(Profit as double) as Profit,
  UnitsSold, SalesOrderNumber, CustomerKey"""


def ranked(source: str, order: str, n: int, where: str = "true", columns: str = "*") -> str:
    return (
        f"select {columns} from (select *, row_number() over (partition by dimension order by {order}, segment) as rank"
        f" from {source} where {where}) where rank <= {n}"
    )


RANKINGS = {
    "top_growth": ("RevenueYoY desc", 5, "not IsNewBase and RevenueYoY is not null"),
    "top_decline": ("RevenueYoY", 5, "not IsNewBase and RevenueYoY is not null"),
    "top_margin": ("MarginPct desc", 5, "MarginPct is not null"),
    "low_margin": ("MarginPct", 5, "MarginPct is not null"),
    "top_risk": ("Revenue desc", 5, "RiskFlag"),
    "top_opportunity": ("Revenue desc", 5, "OpportunityFlag"),
    "new_segments": ("Revenue desc", 8, "IsNewBase"),
}

GLOBAL = f"""
g as (
  select *, {ratio("Profit", "Revenue")} as MarginPct, {ratio("Revenue", "Orders")} as AOV,
    {ratio("Revenue", "Customers")} as RevPerCustomer
  from (select {SUMS}, {COUNTS} from s))"""

YEARLY_KPI = f"yk as (select CalendarYear, {SUMS}, {COUNTS} from s group by CalendarYear)"


def headline() -> str:
    parts = [
        f"select '{m}' as measure, cast(a.{m} as double) as Latest, cast(b.{m} as double) as Previous,"
        f" {change(f'a.{m}', f'b.{m}')} as YoY from two"
        for m in ("Revenue", "Profit", "UnitsSold", "Orders", "Customers")
    ]
    parts.append(
        f"select 'MarginPct' as measure, {ratio('a.Profit', 'a.Revenue')} as Latest,"
        f" {ratio('b.Profit', 'b.Revenue')} as Previous, cast(null as double) as YoY from two"
    )
    return (
        "two as (select a, b from yk a, yk b, pair where a.CalendarYear = ly and b.CalendarYear = py),\n"
        f"headline as ({' union all '.join(parts)})"
    )


ATTACH = f"""
ord as (
  select SalesOrderNumber, coalesce(bool_or(ProductCategory = 'PROMO'), false) as HasAnchor,
    coalesce(bool_or(ProductCategory = 'SMALL'), false) as HasAttach
  from s group by SalesOrderNumber),
att as (
  select *, GapOrders * AvgAttachBasket as AddressableRevenue,
    GapOrders * AvgAttachBasket * AttachMargin as AddressableProfit
  from (
    select 'PROMO' as Anchor, 'SMALL' as Attach, AnchorOrders, AttachedOrders, AnchorOrders - AttachedOrders as GapOrders,
      {ratio("AttachedOrders", "AnchorOrders")} as AttachRate, AttachCategoryOrders,
      {ratio("rev", "AttachCategoryOrders")} as AvgAttachBasket, {ratio("prof", "rev")} as AttachMargin
    from (
      select count(*) filter (HasAnchor) as AnchorOrders, count(*) filter (HasAnchor and HasAttach) as AttachedOrders,
        count(*) filter (HasAttach) as AttachCategoryOrders from ord),
      (select coalesce(sum(Revenue), 0) as rev, coalesce(sum(Profit), 0) as prof from s where ProductCategory = 'SMALL')))"""


def outlook(source: str, by: str = "") -> str:
    """Least squares in closed form, with year offsets from the first year."""
    keys = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    group = f"group by {by}" if by else ""
    return f"""
ol_a as (
  select {keys}CalendarYear as y, cast(Revenue as double) as v,
    cast(Revenue as double) < lag(cast(Revenue as double)) over ({part}order by CalendarYear) as fell,
    CalendarYear - min(CalendarYear) over ({part[:-1]}) as x
  from {source}),
ol_b as (
  select {keys}count(*) as Years, min(y) as FirstYear, max(y) as LastYear, arg_min(v, y) as f, arg_max(v, y) as l,
    sum(x) as sx, sum(v) as sv, sum(x * v) as sxv, sum(x * x) as sxx, coalesce(bool_or(fell), false) as Volatile
  from ol_a {group}),
ol_c as (
  select *, LastYear + 1 as NextYear, case when f > 0 and LastYear > FirstYear
      then pow(l / f, 1.0::double / (LastYear - FirstYear)) - 1 end as CAGR,
    (Years * sxv - sx * sv) / (Years * sxx - sx * sx)::double as slope
  from ol_b where Years >= 2),
ol as (
  select *, sv / Years + slope * (NextYear - FirstYear - sx / Years::double) as LinearNext, l * (1 + CAGR) as CagrNext
  from ol_c)"""


OUTLOOK_COLUMNS = (
    "Years, FirstYear, LastYear, NextYear, round(CAGR, 6) as CAGR, round(LinearNext, 2) as LinearNext,"
    " round(CagrNext, 2) as CagrNext, round(least(LinearNext, CagrNext), 2) as Low,"
    " round(greatest(LinearNext, CagrNext), 2) as High, Volatile"
)

REBOUND_COLUMNS = (
    "cast(RevenueLatest as double) as RevenueLatest, cast(RevenuePrevious as double) as RevenuePrevious,"
    " cast(RevenuePrior as double) as RevenuePrior, coalesce(RevenuePrevious < RevenuePrior, false) as IsRebound,"
    f" {r(change('RevenueLatest', 'RevenuePrevious'))} as LatestVsPrevious,"
    f" {r(change('RevenueLatest', 'RevenuePrior'))} as LatestVsPrior"
)

REBOUND = """
  select a.Revenue as RevenueLatest, b.Revenue as RevenuePrevious, c.Revenue as RevenuePrior,
    coalesce(c.Months = 12, false) as PriorComplete
  from pair join months a on a.CalendarYear = ly join months b on b.CalendarYear = py
    left join months c on c.CalendarYear = py - 1"""


def attach_matrix() -> str:
    return (
        FACT + ", oc as (select distinct SalesOrderNumber as o, ProductCategory as c from s),"
        " na as (select c, count(*) as n from oc group by c)"
        " select a.c as Anchor, b.c as Attach, any_value(na.n) as AnchorOrders, count(*) as AttachedOrders,"
        f" {r('count(*)::double / any_value(na.n)')} as AttachRate"
        " from oc a join oc b on a.o = b.o and a.c <> b.c join na on na.c = a.c group by a.c, b.c"
    )


def unpivot(
    section: str, source: str, values: Sequence[str], texts: Sequence[str] = (), dimension: str = "null",
    rank: str = "null", segment: str = "null", digits: int = 4,
) -> str:
    keys = (
        f"'{section}' as section, cast({dimension} as varchar) as dimension, cast({rank} as bigint) as rank,"
        f" cast({segment} as varchar) as segment"
    )
    parts = [
        f"select {keys}, '{v}' as metric, {r(v, digits)} as value, cast(null as varchar) as text from {source}"
        for v in values
    ]
    parts += [f"select {keys}, '{t}' as metric, cast(null as double) as value, cast({t} as varchar) as text from {source}" for t in texts]
    return " union all ".join(parts)


def distribution() -> str:
    return " union all ".join(
        f"select '{k}' as kind, {k} as label, count(*) as Segments from yoy group by {k}"
        for k in ("BusinessSignal", "GrowthStatus", "MarginStatus")
    )


def report_facts() -> str:
    ctes = [
        SALES, SEGMENTS, YEARS, SEGMENT_YEARS, yoy_tables(), GLOBAL, YEARLY_KPI, headline(), ATTACH,
        outlook("(select * from months where Months = 12)"), f"dist as ({distribution()})",
        f"hist as ({ranked('segk', 'Revenue desc', 8)})",
        "flags as (select count(*) filter (RiskFlag) as RiskSegments,"
        " count(*) filter (OpportunityFlag) as OpportunitySegments from yoy)",
        f"rb as ({REBOUND}), rbk as (select {REBOUND_COLUMNS}, PriorComplete from rb)",
        "olf as (select *, least(LinearNext, CagrNext) as Low, greatest(LinearNext, CagrNext) as High from ol)",
    ]
    keys = {"dimension": "dimension", "rank": "rank", "segment": "segment"}
    parts = [
        unpivot("kpi_global", "g", KPI_COLUMNS),
        unpivot("revenue_by_year", "months", ["Revenue"], segment="CalendarYear"),
        unpivot("headline_yoy", "headline", ["Latest", "Previous", "YoY"], segment="measure"),
        unpivot(
            "rebound", "rbk",
            ["RevenueLatest", "RevenuePrevious", "RevenuePrior", "LatestVsPrevious", "LatestVsPrior"],
            ["IsRebound", "PriorComplete"],
        ),
        unpivot("history", "hist", (*KPI_COLUMNS, "RevenueShare"), **keys),
    ]
    for name, (order, n, where) in RANKINGS.items():
        ctes.append(f"{name} as ({ranked('yoy', order, n, where)})")
        parts.append(unpivot(name, name, FIGURES, ["BusinessSignal"], **keys))
    parts += [
        unpivot("signal_distribution", "dist", ["Segments"], dimension="kind", segment="label"),
        unpivot("flag_counts", "flags", ["RiskSegments", "OpportunitySegments"]),
        unpivot(
            "attach_analysis", "att",
            ["AnchorOrders", "AttachedOrders", "GapOrders", "AttachRate", "AttachCategoryOrders", "AvgAttachBasket",
             "AttachMargin", "AddressableRevenue", "AddressableProfit"],
            digits=2,
        ),
        unpivot(
            "revenue_outlook", "olf", ["NextYear", "CAGR", "LinearNext", "CagrNext", "Low", "High"], ["Volatile"], digits=2
        ),
        unpivot(
            "chart_year_bars",
            "(select *, cast(Revenue as double) / 1e6 as RevenueM from months where cast(Revenue as double)"
            " >= 0.05::double * (select cast(max(Revenue) as double) from months))",
            ["RevenueM"], segment="CalendarYear",
        ),
        unpivot("chart_share", "charted", ["RevenueM", "SharePct"], **keys),
        unpivot(
            "opportunity_matrix", "matrix", ["RevenueM", "MarginPct", "MedianRevenueM", "GlobalMarginPct", "BubbleSize"],
            ["IsPriority"], **keys,
        ),
        unpivot(
            "concentration", "(select * from hist where rank = 1)", ["Revenue", "RevenueShare"], dimension="dimension",
            segment="segment",
        ),
    ]
    charted = "dimension in ('ProductCategory', 'Country', 'Occupation')"
    ctes += [
        "charted as (select *, cast(Revenue as double) / 1e6 as RevenueM, RevenueShare * 100 as SharePct"
        f" from ({ranked('segk', 'Revenue desc', 6, charted)}))",
        "shown as (select *, cast(Revenue as double) / 1e6 as RevenueM from segk where dimension = 'ProductCategory'"
        " and MarginPct is not null order by Revenue desc, segment limit 10)",
        "matrix as (select * exclude (med, gm, best), row_number() over (order by Revenue desc, segment) as rank,"
        " med as MedianRevenueM, gm as GlobalMarginPct, cast(Revenue as double) / cast(best as double) * 520 + 90 as BubbleSize,"
        " RevenueM >= med and MarginPct >= gm as IsPriority from shown, (select median(RevenueM) as med, max(Revenue) as best,"
        " (select sum(Profit)::double / sum(Revenue)::double from s) as gm from shown))",
    ]
    return with_(*ctes) + " union all ".join(parts)


def report_text() -> str:
    whole = "format('{:,.0f}', value)"
    kind = "case when section = 'headline_yoy' and metric <> 'YoY' then segment else metric end"
    money = """'Revenue', 'Profit', 'AOV', 'RevPerCustomer', 'RevenueLatest', 'RevenuePrevious', 'RevenuePrior',
      'AvgAttachBasket', 'AddressableRevenue', 'AddressableProfit', 'LinearNext', 'CagrNext', 'Low', 'High'"""
    percent = """'MarginPct', 'MarginDelta', 'RevenueShare', 'RevenueYoY', 'ProfitYoY', 'OrdersYoY', 'CustomersYoY',
      'YoY', 'LatestVsPrevious', 'LatestVsPrior', 'AttachRate', 'AttachMargin', 'CAGR', 'GlobalMarginPct'"""
    return f"""select section, dimension, rank, segment, metric, coalesce(text,
      case when kind in ({money}) then {whole} || ' €' when kind in ({percent}) then format('{{:.1f}}', value * 100) || '%'
        when kind in ('RevenueM', 'MedianRevenueM') then format('{{:,.1f}}', value) || 'M €'
        when kind = 'SharePct' then format('{{:.0f}}', value) || '%'
        when kind = 'NextYear' then cast(cast(value as bigint) as varchar) else {whole} end, 'N/A') as display
      from (select *, {kind} as kind from ({report_facts()}))"""


def formatted() -> str:
    money = {"Revenue", "Profit", "AOV", "RevPerCustomer"}
    parts = []
    for name in KPI_COLUMNS:
        if name == "MarginPct":
            text = "format('{:.1f}', MarginPct * 100) || '%'"
        else:
            text = f"format('{{:,.0f}}', cast({name} as double))" + (" || ' €'" if name in money else "")
        parts.append(f"select '{name}' as metric, coalesce({text}, 'N/A') as formatted from g")
    return with_(SALES, GLOBAL) + " union all ".join(parts)


SALES_VIEW = """cast(l_orderkey as varchar) as SalesOrderNumber,
  cast(year(odate) * 10000 + month(odate) * 100 + day(odate) as bigint) as OrderDateKey, l_partkey as ProductKey,
  o_custkey as CustomerKey, cast(c_nationkey as bigint) as SalesTerritoryKey, cast(l_quantity as bigint) as OrderQuantity,
  cast(cast(p_retailprice as decimal(18,2)) as double) as UnitPrice, cast(amount as double) as SalesAmount,
  cast(cost as double) as TotalProductCost"""

ORPHANS = {
    "Sales_Without_Product": "from lines left join part on l_partkey = p_partkey where p_partkey is null",
    "Sales_Without_Customer": "from lines left join customer c on lines.o_custkey = c.c_custkey where c.c_custkey is null",
    "Sales_Without_Date": "from lines left join cal on odate = FullDate where FullDate is null",
    "Sales_Without_Territory": "from lines left join nation n on lines.c_nationkey = n.n_nationkey"
    " where n.n_nationkey is null",
    "Orders_Without_Sales": "from orders where o_orderkey not in (select l_orderkey from lineitem)",
}
COUNTED = {
    "vw_Sales": "lineitem", "vw_Product": "part", "vw_Customer": "customer", "vw_Date": "cal", "vw_Territory": "nation",
}
KEYS = {
    "vw_Product.ProductKey": "part group by p_partkey",
    "vw_Customer.CustomerKey": "customer group by c_custkey",
    "vw_Date.DateKey": "cal group by DateKey",
    "vw_Territory.SalesTerritoryKey": "nation group by n_nationkey",
}
RULES = {"negative_amount": "amount < 0", "negative_cost": "cost < 0", "non_positive_quantity": "l_quantity <= 0"}
NULLABLE = {
    "SalesOrderNumber": "l_orderkey", "ProductKey": "l_partkey", "CustomerKey": "o_custkey", "OrderDateKey": "odate",
    "SalesTerritoryKey": "c_nationkey", "SalesAmount": "amount", "TotalProductCost": "cost",
}


def dq_summary() -> str:
    parts = [
        f"select 'row_count' as \"check\", '{name}' as target, count(*) as observed, count(*) > 0 as passed from {table}"
        for name, table in COUNTED.items()
    ]

    def zero(check: str, target: str, rows: str) -> str:
        return f"select '{check}', '{target}', count(*), count(*) = 0 from {rows}"

    parts += [zero("null_values", name, f"lines where {c} is null") for name, c in NULLABLE.items()]
    parts += [zero("anomalies", name, f"lines where {rule}") for name, rule in RULES.items()]
    parts += [zero("duplicate_keys", n, f"(select 1 from {g} having count(*) > 1)") for n, g in KEYS.items()]
    parts += [zero("orphans", n, f"(select 1 {rest})") for n, rest in ORPHANS.items()]
    dup = "(select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)"
    parts.append(zero("duplicate_lines", "SalesOrderNumber+SalesOrderLineNumber", dup))
    parts.append(
        "select 'grain', 'SalesOrderNumber+SalesOrderLineNumber', count(*) - count(distinct (l_orderkey, l_linenumber)),"
        " count(*) = count(distinct (l_orderkey, l_linenumber)) from lineitem"
    )
    gaps = "date_diff('day', min(FullDate), max(FullDate)) + 1 - count(distinct FullDate)"
    parts.append(f"select 'date_gaps', 'FullDate', {gaps}, {gaps} = 0 from cal")
    parts.append(zero("date_nulls", "CalendarYear+MonthNumberOfYear+MonthYear", "cal where CalendarYear is null"))
    return with_(SALES, CALENDAR) + " union all ".join(parts)


def business_signal() -> str:
    """Both years side by side in one grouping per dimension."""

    def at(year: str, measure: str) -> str:
        return f"sum({measure}) filter (CalendarYear = {year})"

    parts = " union all ".join(
        f"select '{d}' as dimension, {d} as segment, {at('ly', 'Revenue')} as cur, {at('py', 'Revenue')} as prev,"
        f" {at('ly', 'Profit')} as profit from s, pair where CalendarYear in (ly, py) group by {d}"
        f" having count(*) filter (CalendarYear = ly) > 0"
        for d in DIMENSIONS
    )
    known = "case when cast(prev as double) >= cast(0.05 as double) * cast(cur as double) then "
    return PERIOD + f""", compared as ({parts}),
rates as (select dimension, segment, {known} {change("cur", "prev")} end as g, {ratio("profit", "cur")} as m from compared)
select dimension, segment, {r("g")} as RevenueYoY, {r("m")} as MarginPct, {signal_case("g", "m")} as signal from rates"""


def rebound_segments() -> str:
    year = "sum(Revenue) filter (CalendarYear = {})"
    measures = (
        f"{year.format('ly')} as RevenueLatest, {year.format('py')} as RevenuePrevious,"
        f" {year.format('py - 1')} as RevenuePrior"
    )
    parts = " union all ".join(
        f"select '{d}' as dimension, {d} as segment, {measures} from s, pair where CalendarYear between py - 1 and ly"
        f" group by {d}"
        for d in DIMENSIONS
    )
    return PERIOD + f", rb as ({parts}) select dimension, segment, {REBOUND_COLUMNS} from rb"


YTD = """
mon as (
  select CalendarYear, YearMonthNumber, sum(Revenue) as Revenue from s where CalendarYear is not null
  group by CalendarYear, YearMonthNumber),
ytd as (
  select a.CalendarYear, a.YearMonthNumber, any_value(a.Revenue) as Revenue, sum(b.Revenue) as RevenueYTD
  from mon a join mon b on a.CalendarYear = b.CalendarYear and b.YearMonthNumber <= a.YearMonthNumber
  group by a.CalendarYear, a.YearMonthNumber)"""

ORACLE: dict[str, str] = {
    "dim_customer": f"""select c_custkey as CustomerKey,
      split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) as CustomerName,
      split_part(c_name, '#', 1) as FirstName, split_part(c_name, '#', 2) as LastName, '55+' as AgeGroup,
      cast(5 as bigint) as AgeGroupSort, c_mktsegment as Occupation,
      cast(cast(c_acctbal as decimal(18,2)) as double) as YearlyIncome, {INCOME} as IncomeGroup,
      cast(case when c_acctbal < 2500 then 1 when c_acctbal < 6000 then 2 else 3 end as bigint) as IncomeGroupSort,
      'Unknown' as HouseOwnerFlag, n_name as Country
      from customer left join nation on c_nationkey = n_nationkey""",
    "dim_product": """select p_partkey as ProductKey, p_name as ProductName, coalesce(p_brand, 'Unknown') as ProductSubcategory,
      coalesce(p_type, 'Unknown') as ProductCategory, 'Other' as ProductLine, cast(p_size as varchar) as Size,
      'No Model' as Status, 'No Model' as ModelName, cast(cast(p_retailprice as decimal(18,2)) as double) as ListPrice
      from part""",
    "dim_customer_bands": f"""select c_custkey as CustomerKey, cast(first as date) as BirthDate,
      case when 2002 - year(first) < 4 then '18-25' when 2002 - year(first) < 5 then '26-35'
        when 2002 - year(first) < 6 then '36-45' when 2002 - year(first) < 7 then '46-55' else '55+' end as AgeGroup,
      cast(case when 2002 - year(first) < 4 then 1 when 2002 - year(first) < 5 then 2 when 2002 - year(first) < 6 then 3
        when 2002 - year(first) < 7 then 4 else 5 end as bigint) as AgeGroupSort,
      case when cast(c_acctbal as decimal(18,2)) >= 5000 then 'Home Owner'
        when cast(c_acctbal as decimal(18,2)) >= 0 then 'Non Home Owner' else 'Unknown' end as HouseOwnerFlag,
      {INCOME} as IncomeGroup, n_name as Country
      from customer left join nation on c_nationkey = n_nationkey
        left join (select o_custkey, min(o_orderdate) as first from orders group by o_custkey) on c_custkey = o_custkey""",
    "dim_product_defaults": """select p_partkey as ProductKey,
      case when p_size % 3 > 0 then coalesce(p_brand, 'Unknown') else 'Unknown' end as ProductSubcategory,
      case when p_type is null or p_type = 'PROMO' then 'Unknown' else p_type end as ProductCategory,
      case when p_size > 25 then 'L' else 'Other' end as ProductLine,
      case when p_size % 2 = 0 then 'Current' else 'No Model' end as Status,
      case when p_size % 5 = 0 then p_name else 'No Model' end as ModelName from part""",
    "dim_promotion": """select cast(round(l_discount * 100) as bigint) as PromotionKey,
      'Discount ' || cast(cast(round(l_discount * 100) as bigint) as varchar) || '%' as PromotionName,
      cast(cast(round(l_discount * 100) as bigint) as double) / 100 as DiscountPct,
      cast(min(o_orderdate) as date) as StartDate, cast(max(l_shipdate) as date) as EndDate,
      date_diff('day', cast(min(o_orderdate) as date), cast(max(l_shipdate) as date)) as PromotionDurationDays
      from lineitem left join orders on l_orderkey = o_orderkey group by round(l_discount * 100)""",
    "dim_territory": """select cast(n_nationkey as bigint) as SalesTerritoryKey, r_name as TerritoryGroup, n_name as Country,
      n_name as Region from nation left join region on n_regionkey = r_regionkey""",
    "dim_date": with_(CALENDAR) + "select * from cal",
    "threshold_band": """select c_custkey,
      case when c_acctbal < 2500 then 'Low Income' when c_acctbal < 6000 then 'Middle Income' else 'High Income' end as band,
      cast(case when c_acctbal < 2500 then 1 when c_acctbal < 6000 then 2 else 3 end as bigint) as band_sort
      from customer""",
    "year_band": """select o_orderkey as OrderKey, cast(y as bigint) as years,
      case when y < 2 then '0-1 years' when y < 4 then '2-3 years' when y < 6 then '4-5 years' else '6+ years' end as band,
      cast(case when y < 2 then 1 when y < 4 then 2 when y < 6 then 3 else 4 end as bigint) as band_sort
      from (select o_orderkey, 2002 - year(o_orderdate) as y from orders)""",
    "code_decode": """select o_orderkey, case o_orderstatus when 'F' then 'Fulfilled' when 'O' then 'Open' else 'Unknown' end
      as status from orders""",
    "date_duration_days": """select l_orderkey as OrderKey, cast(o_orderdate as date) as OrderDate,
      cast(l_shipdate as date) as ShipDate,
      cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as bigint) as DurationDays
      from lineitem left join orders on l_orderkey = o_orderkey""",
    "fact_sales": FACT + f"select {SALES_VIEW} from lines",
    "sales_raw": FACT + f"select {RAW_COLUMNS} from s",
    "star_join": FACT + f"select {RAW_COLUMNS} from s",
    "active_filters": FACT + f"select {RAW_COLUMNS} from s where TerritoryGroup = 'ASIA'",
    "preview_top100": FACT + f"""select {RAW_COLUMNS} from (select * from s order by YearMonthNumber, Country,
      ProductCategory, CalendarYear, CustomerKey, IncomeGroup, MonthYear, Occupation, ProductSubcategory, Profit,
      QuarterLabel, Revenue, SalesOrderNumber, TerritoryGroup, UnitsSold limit 100)""",
    "dq_row_counts": with_(CALENDAR)
    + " union all ".join(f"select '{n}' as TableName, count(*) as Row_Count from {t}" for n, t in COUNTED.items()),
    "dq_null_counts": """select count(*) as TotalRows, count(*) filter (l_orderkey is null) as Missing_SalesOrderNumber,
      count(*) filter (l_partkey is null) as Missing_ProductKey, count(*) filter (o_custkey is null) as Missing_CustomerKey,
      count(*) filter (o_orderdate is null) as Missing_OrderDate,
      count(*) filter (l_extendedprice * (1 - l_discount) is null) as Missing_SalesAmount
      from orders full join lineitem on l_orderkey = o_orderkey""",
    "dq_key_uniqueness": """select 'vw_Territory' as TableName, r_name as KeyValue, count(*) as DuplicateCount
      from nation left join region on n_regionkey = r_regionkey group by r_name having count(*) > 1
      union all select 'vw_Product', cast(p_partkey as varchar), count(*) from part group by p_partkey having count(*) > 1
      union all select 'vw_Customer', cast(c_custkey as varchar), count(*) from customer group by c_custkey
      having count(*) > 1""",
    "dq_orphans": with_(SALES, CALENDAR)
    + " union all ".join(f"select '{n}' as Relationship, count(*) as Orphans {rest}" for n, rest in ORPHANS.items()),
    "dq_duplicate_lines": """select l_orderkey as OrderKey, cast(l_linenumber as bigint) as SalesOrderLineNumber,
      count(*) as DuplicateCount from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "dq_anomaly_rows": """select c_custkey as CustomerKey, split_part(c_name, '#', 2) as LastName,
      cast(cast(c_acctbal as decimal(18,2)) as double) as YearlyIncome from customer
      where cast(c_acctbal as decimal(18,2)) < 0""",
    "dq_sales_anomaly_rows": FACT + f"""select {SALES_VIEW} from lines
      where amount < 0 or cost < 0 or cast(l_quantity as int) <= 0""",
    "dq_loss_rows": FACT + f"""select {SALES_VIEW} from lines
      where amount < cost or (cast(l_quantity as int) = 1 and amount > cast(p_retailprice as decimal(18,2)))""",
    "dq_anomaly_counts": FACT
    + "select "
    + ", ".join(f"count(*) filter ({rule}) as {n}" for n, rule in RULES.items())
    + f", count(*) filter ({' or '.join(RULES.values())}) as any_rule from lines",
    "dq_date_range": """select min(d) as MinDate, max(d) as MaxDate, count(*) as DateRows,
      cast(date_diff('day', min(d), max(d)) + 1 as bigint) as ExpectedDays from days""",
    "dq_date_nulls": with_(CALENDAR) + """select DateKey, CalendarYear, MonthNumberOfYear, MonthYear from cal
      where CalendarYear is null or MonthNumberOfYear is null or MonthYear is null""",
    "dq_ship_date_nulls": """select cast(l_shipdate as date) as ShipDate, count(*) as Lines, cast(null as bigint) as CalendarYear
      from lineitem where cast(l_shipdate as date) < (select cast(min(o_orderdate) as date) from orders)
        or cast(l_shipdate as date) > (select cast(max(o_orderdate) as date) from orders) group by 1""",
    "dq_order_days": """select min(d) as MinDate, max(d) as MaxDate, count(*) as DateRows,
      cast(date_diff('day', min(d), max(d)) + 1 as bigint) as ExpectedDays
      from (select distinct cast(o_orderdate as date) as d from orders where o_orderpriority = '1-URGENT')""",
    "dq_grain": """select count(*) as TotalRows, count(distinct (l_orderkey, l_linenumber)) as DistinctOrderLines
      from lineitem""",
    "dq_summary": dq_summary(),
    "validation_totals": FACT + f"""select cast(sum(amount) as double) as Revenue, cast(sum(amount - cost) as double) as Profit,
      {r(ratio("sum(amount - cost)", "sum(amount)"))} as MarginRate, count(distinct l_orderkey) as Orders from lines""",
    "sales_by_year": FACT + f"""select cast(year(odate) as bigint) as CalendarYear, cast(sum(amount) as double) as Revenue,
      cast(sum(amount - cost) as double) as Profit, {r(ratio("sum(amount - cost)", "sum(amount)"))} as MarginRate
      from lines group by year(odate) order by 1""",
    "kpi_global": with_(SALES, GLOBAL) + f"select {cols(*KPI_COLUMNS)} from g",
    "revenue_by_year": PERIOD + f"select CalendarYear, {col('Revenue')} from months",
    "months_per_year": PERIOD + "select CalendarYear, Months from months",
    "segment_kpis": KPI + f"select {cols(*SEGMENT_COLUMNS)} from segk where dimension = 'ProductCategory'",
    "segment_kpis_all_dims": KPI + f"select {cols(*SEGMENT_COLUMNS)} from segk",
    "segment_kpis_grouping_sets": KPI + f"select {cols(*SEGMENT_COLUMNS)} from segk",
    "hist_segments_top8": KPI + ranked("segk", "Revenue desc", 8, columns=cols(*SEGMENT_COLUMNS, "rank")),
    "concentration_leader": KPI
    + ranked("segk", "Revenue desc", 1, columns=cols("dimension", "segment", "Revenue", "RevenueShare")),
    "comparable_years": PERIOD + "select ly as LatestYear, py as PreviousYear from pair",
    "yoy_by_year": PERIOD + f"""select a.CalendarYear, cast(a.Revenue as double) as Revenue,
      cast(b.Revenue as double) as RevenueLY, {r(change("a.Revenue", "b.Revenue"))} as RevenueYoY
      from months a left join months b on b.CalendarYear = a.CalendarYear - 1""",
    "headline_yoy": with_(SALES, YEARS, YEARLY_KPI, headline())
    + "select measure, round(Latest, 6) as Latest, round(Previous, 6) as Previous, round(YoY, 6) as YoY from headline",
    "rebound_flag": PERIOD + f", rb as ({REBOUND}) select {REBOUND_COLUMNS}, PriorComplete from rb",
    "rebound_by_segment": rebound_segments(),
    "ytd_revenue": with_(SALES, YTD) + """select CalendarYear, YearMonthNumber, cast(Revenue as double) as Revenue,
      cast(RevenueYTD as double) as RevenueYTD from ytd""",
    "ytd_vs_prior": with_(SALES, YTD) + f"""select a.CalendarYear, a.YearMonthNumber, cast(a.Revenue as double) as Revenue,
      cast(a.RevenueYTD as double) as RevenueYTD, cast(b.RevenueYTD as double) as RevenueYTDPrior,
      {r(change("a.RevenueYTD", "b.RevenueYTD"))} as YTDYoY
      from ytd a left join ytd b on b.YearMonthNumber = a.YearMonthNumber - 100""",
    "segment_yoy": YOY + f"select {cols(*YOY_COLUMNS)} from yoy where dimension = 'ProductCategory'",
    "segment_yoy_all_dims": YOY + f"select {cols(*YOY_COLUMNS)} from yoy",
    "segment_yoy_new_base": LAUNCH + f"select {cols(*YOY_COLUMNS)} from yoy",
    "growth_status": YOY + f"select dimension, segment, {col('RevenueYoY')}, GrowthStatus as status from yoy",
    "margin_status": KPI
    + f"select dimension, segment, {col('MarginPct')}, {margin_case('MarginPct')} as status from segk",
    "business_signal": business_signal(),
    "signal_distribution": YOY + distribution(),
    "flag_counts": YOY + """select count(*) filter (RiskFlag) as RiskSegments,
      count(*) filter (OpportunityFlag) as OpportunitySegments from yoy""",
    **{
        name: YOY + ranked("yoy", order, n, where, cols(*RANKED_COLUMNS))
        for name, (order, n, where) in RANKINGS.items()
    },
    "new_segments": LAUNCH
    + ranked(
        "yoy", "Revenue desc", 8, "IsNewBase",
        cols("dimension", "rank", "segment", "Revenue", "RevenueShare", "MarginPct", "BusinessSignal"),
    ),
    "opportunity_matrix": KPI + f""", om as (
      select *, cast(Revenue as double) / 1e6 as RevenueM from segk
      where dimension = 'ProductCategory' and MarginPct is not null order by Revenue desc, segment limit 10),
      ref as (select median(RevenueM) as med, max(Revenue) as best, (select sum(Profit)::double / sum(Revenue)::double from s)
        as gm from om)
      select row_number() over (order by Revenue desc, segment) as rank, segment, {r("RevenueM")} as RevenueM,
        {col("MarginPct")}, {r("med")} as MedianRevenueM, {r("gm")} as GlobalMarginPct,
        {r("cast(Revenue as double) / cast(best as double) * 520 + 90")} as BubbleSize,
        RevenueM >= med and MarginPct >= gm as IsPriority
      from om, ref""",
    "chart_year_bars": PERIOD + f"""select CalendarYear, {r("cast(Revenue as double) / 1e6")} as RevenueM from months
      where cast(Revenue as double) >= 0.05::double * (select cast(max(Revenue) as double) from months)""",
    "chart_share_top6": KPI
    + ranked(
        "segk", "Revenue desc", 6, "dimension in ('ProductCategory', 'Country', 'Occupation')",
        f"dimension, rank, segment, {r('cast(Revenue as double) / 1e6')} as RevenueM,"
        f" {r('RevenueShare * 100')} as SharePct",
    ),
    "order_membership": with_(SALES, ATTACH) + "select SalesOrderNumber, HasAnchor, HasAttach from ord",
    "attach_analysis": with_(SALES, ATTACH) + f"""select Anchor, Attach, AnchorOrders, AttachedOrders, GapOrders,
      {r("AttachRate")} as AttachRate, AttachCategoryOrders, {r("AvgAttachBasket", 4)} as AvgAttachBasket,
      {r("AttachMargin")} as AttachMargin, {r("AddressableRevenue", 2)} as AddressableRevenue,
      {r("AddressableProfit", 2)} as AddressableProfit from att""",
    "attach_matrix": attach_matrix(),
    "revenue_outlook": with_(SALES, YEARS, outlook("(select * from months where Months = 12)"))
    + f"select {OUTLOOK_COLUMNS} from ol",
    "revenue_outlook_by_segment": with_(
        SALES,
        YEARS,
        f"sy as ({per_dimension('sum(Revenue) as Revenue', 'CalendarYear')})",
        outlook(
            "(select * from sy where CalendarYear in (select CalendarYear from months where Months = 12))",
            "dimension, segment",
        ),
    )
    + f"select dimension, segment, {OUTLOOK_COLUMNS} from ol",
    "formatted_kpis": formatted(),
    "report_facts": report_facts(),
    "report_text": report_text(),
}
ORACLE["dq_date_range"] = with_(CALENDAR) + ORACLE["dq_date_range"]
for _name in ("control_totals", "load_export_roundtrip"):
    ORACLE[_name] = FACT + """select count(*) as Row_Count, min(CalendarYear) as MinYear, max(CalendarYear) as MaxYear,
      cast(sum(Revenue) as double) as TotalRevenue, cast(sum(Profit) as double) as TotalProfit from s"""
