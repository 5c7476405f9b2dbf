"""Equivalent SQL for the registered queries, written for an independent engine.

The statements share a few common table expressions and otherwise state each definition
directly: recurrences as recursive queries, trees level by level, systems by elimination.
"""

from __future__ import annotations

from barloom.plans.registry import ASOF, EVENT_ASOF, FINE, FINE_COLUMNS, OFFSET, SCALE, SPLIT, STREAM_CUTS
from barloom.schema import INDEX_CODES, STANDARD_COLUMNS, VALUES

ORDER = "ROW(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)"

BARS = f"""bars AS MATERIALIZED (
  SELECT CAST(l_suppkey AS VARCHAR) AS code, CAST(l_shipdate AS DATE) AS date,
         arg_min(v, o) AS open, max(v) AS high, min(v) AS low, arg_max(v, o) AS close,
         sum(q) AS volume, arg_max(v, o) AS adj_close
  FROM (SELECT l_suppkey, l_shipdate, l_extendedprice / l_quantity AS v, l_quantity AS q, {ORDER} AS o
        FROM lineitem) GROUP BY ALL)"""

COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in VALUES)
VALID = f"valid AS MATERIALIZED (SELECT * FROM bars WHERE isodow(date) <= 5 AND {COMPLETE})"
KEPT = """kept AS MATERIALIZED (
  SELECT * EXCLUDE (rd) FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS rd FROM valid)
  WHERE rd <= {days})"""

TICKS = """ticks AS (SELECT event_type AS code, ts, event_id AS seq, value FROM events WHERE value IS NOT NULL)"""

SUPPLIERS = "symbols AS (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier)"
LISTED = (
    "listed AS (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', '{c}'" for c in INDEX_CODES)
    + ")"
)
IS_INDEX = "code IN (" + ", ".join(f"'{c}'" for c in INDEX_CODES) + ")"


def rnd(expr: str, name: str | None = None) -> str:
    """The value in the same steps as the registered queries."""
    scale = FINE if (name or expr) in FINE_COLUMNS else SCALE
    return f"floor(({expr}) * {scale:.1e} + {OFFSET}e0) / {scale:.1e} AS {name or expr}"


def rnds(cols) -> str:
    return ", ".join(rnd(c) for c in cols)


def query(body: str, *ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {body}"


# ---- indicators ------------------------------------------------------------------------------


def series(source: str) -> list[str]:
    """The numbered series with the columns that several definitions share."""
    return [
        f"""s AS MATERIALIZED (
  SELECT *, row_number() OVER w AS rn, adj_close AS c, lag(adj_close) OVER w AS pc, (high + low + adj_close) / 3 AS tp,
         adj_close / first_value(adj_close) OVER w AS ri
  FROM {source} WINDOW w AS (PARTITION BY code ORDER BY date))"""
    ]


def over(n: int) -> str:
    return f"OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


LAG = "OVER (PARTITION BY code ORDER BY date)"


def since(row: int, expr: str) -> str:
    return f"CASE WHEN rn >= {row} THEN {expr} END"


def zdiv(num: str, den: str, scale: str = "1.0") -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE ({num}) / ({den}) * {scale} END"


def wilder(state: str, x: str, n: int) -> str:
    """Next value of an average seeded by the mean of the n changes in rows 2 .. n+1."""
    return (
        f"CASE WHEN b.rn <= {n} THEN {state} + {x} WHEN b.rn = {n + 1} THEN ({state} + {x}) / {n}.0 "
        f"ELSE ({state} * {n - 1}.0 + {x}) / {n}.0 END"
    )


def ema(state: str, x: str, n: int, start: int) -> str:
    """Next value of an average seeded by the mean of n rows from ``start`` on."""
    seed = start + n - 1
    return (
        f"CASE WHEN b.rn < {start} THEN 0.0 WHEN b.rn < {seed} THEN {state} + {x} "
        f"WHEN b.rn = {seed} THEN ({state} + {x}) / {n}.0 ELSE {state} + ({x} - {state}) * (2.0 / {n + 1}.0) END"
    )


def walk(name: str, states: dict[str, str], first: dict[str, str] | None = None, source: str = "s") -> str:
    """Recursive walk over the rows of every symbol; states see r (before), b (row) and each other as new_<x>."""
    first = first or {}
    start = ", ".join(f"CAST({first.get(k, '0.0')} AS DOUBLE) AS {k}" for k in states)
    step = ", ".join(f"{e} AS new_{k}" for k, e in states.items())
    keep = ", ".join(f"new_{k}" for k in states)
    return f"""{name} AS (
  SELECT code, date, rn, {start} FROM {source} AS b WHERE rn = 1
  UNION ALL
  SELECT code, date, rn, {keep} FROM (
    SELECT b.code, b.date, b.rn, {step} FROM {name} AS r JOIN {source} AS b ON b.code = r.code AND b.rn = r.rn + 1))"""


def window_table(name: str, cols: dict[str, str], source: str = "s", inner: str | None = None) -> str:
    body = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    return f"{name} AS (SELECT code, date, rn, {body} FROM {inner or source})"


def t_sma(ns=(5, 25, 50, 75, 200)):
    return [window_table("i_sma", {f"sma{n}": since(n, f"avg(c) {over(n)}") for n in ns})], [f"sma{n}" for n in ns]


def t_ewma(ns=(5, 25, 50, 75, 200)):
    states = {}
    for n in ns:
        q = f"(1.0 - 2.0 / {n + 1}.0)"
        states[f"a{n}"] = f"r.a{n} * {q} + b.c"
        states[f"d{n}"] = f"r.d{n} * {q} + 1.0"
    first = {f"a{n}": "c" for n in ns} | {f"d{n}": "1.0" for n in ns}
    return [
        walk("w_ewma", states, first),
        window_table("i_ewma", {f"ewma{n}": f"a{n} / d{n}" for n in ns}, "w_ewma"),
    ], [f"ewma{n}" for n in ns]


def t_rsi(ns=(9, 14)):
    states = {}
    for n in ns:
        states[f"u{n}"] = wilder(f"r.u{n}", "greatest(b.c - b.pc, 0.0)", n)
        states[f"d{n}"] = wilder(f"r.d{n}", "greatest(b.pc - b.c, 0.0)", n)
    cols = {f"rsi{n}": since(n + 1, zdiv(f"u{n}", f"u{n} + d{n}", "100.0")) for n in ns}
    return [walk("w_rsi", states), window_table("i_rsi", cols, "w_rsi")], list(cols)


def t_mfi(n=14):
    inner = f"(SELECT *, tp * volume AS flow, lag(tp) {LAG} AS ptp FROM s)"
    sums = (
        f"(SELECT *, sum(CASE WHEN tp > ptp THEN flow ELSE 0 END) {over(n)} AS pos, "
        f"sum(CASE WHEN tp < ptp THEN flow ELSE 0 END) {over(n)} AS neg FROM {inner})"
    )
    col = since(n + 1, "CASE WHEN pos + neg < 1 THEN 0.0 ELSE 100.0 * pos / (pos + neg) END")
    return [window_table("i_mfi", {f"mfi{n}": col}, inner=sums)], [f"mfi{n}"]


def t_roc(ns=(10, 25, 50, 75, 150)):
    cols = {
        f"roc{n}": since(
            n + 1, f"CASE WHEN lag(c, {n}) {LAG} = 0 THEN 0.0 ELSE (c / lag(c, {n}) {LAG} - 1.0) * 100.0 END"
        )
        for n in ns
    }
    return [window_table("i_roc", cols)], list(cols)


def t_mom(ns=(10, 25)):
    cols = {f"mom{n}": f"c - lag(c, {n}) {LAG}" for n in ns}
    return [window_table("i_mom", cols)], list(cols)


def t_cci(n=14):
    inner = f"(SELECT *, avg(tp) {over(n)} AS m, list(tp) {over(n)} AS l FROM s)"
    spread = f"(SELECT *, list_sum([abs(x - m) for x in l]) / {n}.0 AS dev FROM {inner})"
    col = since(n, "CASE WHEN least(abs(tp - m), dev) <= abs(m) * 1e-13 THEN 0.0 ELSE (tp - m) / (0.015 * dev) END")
    return [window_table("i_cci", {f"cci{n}": col}, inner=spread)], [f"cci{n}"]


RANGES = "(SELECT *, CASE WHEN rn > 1 THEN greatest(high, pc) - least(low, pc) END AS trv, CASE WHEN rn > 1 THEN c - least(low, pc) END AS bp FROM s)"


def t_ultosc():
    def part(n):
        return zdiv(f"sum(bp) {over(n)}", f"sum(trv) {over(n)}")

    col = since(29, f"100.0 * (4.0 * ({part(7)}) + 2.0 * ({part(14)}) + ({part(28)})) / 7.0")
    return [window_table("i_ultosc", {"ultosc": col}, inner=RANGES)], ["ultosc"]


def _raw_k(n):
    ll, hh = f"min(low) {over(n)}", f"max(high) {over(n)}"
    return f"(SELECT *, {since(n, zdiv(f'c - {ll}', f'{hh} - {ll}', '100.0'))} AS k FROM s)"


def t_stoch():
    inner = f"(SELECT *, {since(7, f'avg(k) {over(3)}')} AS sk FROM {_raw_k(5)})"
    cols = {"slowk": since(9, "sk"), "slowd": since(9, f"avg(sk) {over(3)}")}
    return [window_table("i_stoch", cols, inner=inner)], list(cols)


def t_stochf():
    cols = {"fastk": since(7, "k"), "fastd": since(7, f"avg(k) {over(3)}")}
    return [window_table("i_stochf", cols, inner=_raw_k(5))], list(cols)


def averaged(name: str, source: str, n: int, kind: int, start: int) -> tuple[list[str], int]:
    """Tables up to ``name`` with the average ``v`` of the column ``v`` that ``source`` knows from row ``start`` on."""
    links = {1: 1, 3: 2, 4: 3, 8: 6}.get(kind, 1)
    first = start + links * (n - 1) + (kind == 6)
    if kind == 0:
        return [window_table(name, {"v": since(first, f"avg(v) {over(n)}")}, source)], first
    if kind == 2:
        inner = f"(SELECT *, list(v) {over(n)} AS l FROM {source})"
        total = " + ".join(f"{i} * l[{i}]" for i in range(1, n + 1))
        return [window_table(name, {"v": since(first, f"({total}) / {n * (n + 1) / 2}")}, inner=inner)], first
    if kind == 5:
        a, b = (n + 1) // 2, n // 2 + 1
        inner = f"(SELECT code, date, rn, {since(start + a - 1, f'avg(v) {over(a)}')} AS v FROM {source})"
        return [window_table(name, {"v": since(first, f"avg(v) {over(b)}")}, inner=inner)], first
    if kind == 6:
        steps = f"(SELECT *, abs(v - lag(v) {LAG}) AS d, abs(v - lag(v, {n}) {LAG}) AS net FROM {source})"
        way = f"(SELECT *, sum(d) {over(n)} AS way FROM {steps})"
        factor = f"{name}_f AS MATERIALIZED (SELECT *, power(CASE WHEN way <= net THEN 1.0 ELSE net / way END * (2.0 / 3.0 - 2.0 / 31.0) + 2.0 / 31.0, 2) AS f FROM {way})"
        state = f"CASE WHEN b.rn < {first - 1} THEN 0.0 WHEN b.rn = {first - 1} THEN b.v ELSE r.y + b.f * (b.v - r.y) END"
        return [factor, walk(f"{name}_w", {"y": state}, source=f"{name}_f"), window_table(name, {"v": since(first, "y")}, f"{name}_w")], first
    states, x = {}, "b.v"
    for k in range(1, links + 1):
        states[f"e{k}"] = ema(f"r.e{k}", x, n, start + (k - 1) * (n - 1))
        x = f"new_e{k}"
    v = 0.7
    col = {
        1: "e1",
        3: "2 * e1 - e2",
        4: "3 * e1 - 3 * e2 + e3",
        8: f"(-power({v}, 3)) * e6 + (3 * (power({v}, 2) + power({v}, 3))) * e5 + "
        f"(-6 * power({v}, 2) - 3 * ({v} + power({v}, 3))) * e4 + (1 + 3 * {v} + power({v}, 3) + 3 * power({v}, 2)) * e3",
    }[kind]
    return [walk(f"{name}_w", states, source=source), window_table(name, {"v": since(first, col)}, f"{name}_w")], first


def average_sql(kinds: tuple[int, int], slow: tuple[int, int], fast: int | None) -> str:
    """Stochastics with the given types and lengths of averages."""
    ctes = [*series("valid"), f"k AS MATERIALIZED (SELECT code, date, rn, k AS v FROM {_raw_k(5)})"]
    a, at = averaged("sk", "k", slow[0], kinds[0], 5)
    b, first = averaged("sd", "sk", slow[1], kinds[1], at)
    ctes += [*a, *b]
    cols, joins = [rnd(since(first, "sk.v"), "slowk"), rnd(since(first, "sd.v"), "slowd")], "sk JOIN sd USING (code, date, rn)"
    if fast:
        c, own = averaged("fd", "k", fast, kinds[0], 5)
        ctes += c
        cols += [rnd(since(own, "k.v"), "fastk"), rnd(since(own, "fd.v"), "fastd")]
        joins += " JOIN k USING (code, date, rn) JOIN fd USING (code, date, rn)"
    return query(f"SELECT code, date, {', '.join(cols)} FROM {joins}", BARS, VALID, *ctes, recursive=True)


def t_macd():
    states = {
        "mf": ema("r.mf", "b.c", 12, 15),
        "ms": ema("r.ms", "b.c", 26, 1),
        "mg": ema("r.mg", "(new_mf - new_ms)", 9, 26),
    }
    cols = {"macd": since(34, "mf - ms"), "macdsignal": since(34, "mg"), "macdhist": since(34, "mf - ms - mg")}
    return [walk("w_macd", states, {"ms": "c"}), window_table("i_macd", cols, "w_macd")], list(cols)


def t_bbands():
    states, x = {}, "b.c"
    for k in range(1, 7):
        states[f"e{k}"] = ema(f"r.e{k}", x, 5, (k - 1) * 4 + 1)
        x = f"new_e{k}"
    v = "0.7"
    mid = (
        f"(-power({v}, 3)) * e6 + (3 * (power({v}, 2) + power({v}, 3))) * e5 + "
        f"(-6 * power({v}, 2) - 3 * ({v} + power({v}, 3))) * e4 + (1 + 3 * {v} + power({v}, 3) + 3 * power({v}, 2)) * e3"
    )
    inner = (
        f"(SELECT w.*, d.sd, {mid} AS mid FROM w_bb w JOIN "
        f"(SELECT code, date, stddev_pop(c) {over(5)} AS sd FROM s) d USING (code, date))"
    )
    cols = {
        "upperband": since(25, "mid + 2.0 * sd"),
        "middleband": since(25, "mid"),
        "lowerband": since(25, "mid - 2.0 * sd"),
    }
    return [walk("w_bb", states, {"e1": "c"}), window_table("i_bbands", cols, inner=inner)], list(cols)


def t_sar(acc=0.02, top=0.2):
    """State: side, stop and extreme for the next row, factor, last high and low, the row's output."""
    step = f"""
    SELECT *, CASE WHEN side > 0 THEN lo <= st ELSE hi >= st END AS flip FROM (
      SELECT b.code, b.date, b.rn, b.high AS hi, b.low AS lo,
        CASE WHEN b.rn = 2 THEN b.low ELSE r.pl END AS pl, CASE WHEN b.rn = 2 THEN b.high ELSE r.ph END AS ph,
        CASE WHEN b.rn > 2 THEN r.side WHEN r.pl - b.low > 0 AND r.pl - b.low > b.high - r.ph THEN -1.0 ELSE 1.0 END AS side,
        CASE WHEN b.rn > 2 THEN r.st WHEN r.pl - b.low > 0 AND r.pl - b.low > b.high - r.ph THEN r.ph ELSE r.pl END AS st,
        CASE WHEN b.rn > 2 THEN r.ep WHEN r.pl - b.low > 0 AND r.pl - b.low > b.high - r.ph THEN b.low ELSE b.high END AS ep,
        CASE WHEN b.rn > 2 THEN r.af ELSE {acc} END AS af
      FROM w_sar r JOIN s b ON b.code = r.code AND b.rn = r.rn + 1)"""
    moved = f"""
    SELECT *, CASE WHEN flip AND side > 0 THEN greatest(ep, ph, hi) WHEN flip THEN least(ep, pl, lo) ELSE st END AS shown,
      CASE WHEN flip THEN {acc} WHEN side > 0 AND hi > ep OR side < 0 AND lo < ep THEN least(af + {acc}, {top}) ELSE af END AS naf,
      CASE WHEN flip AND side > 0 THEN lo WHEN flip THEN hi
           WHEN side > 0 THEN greatest(ep, hi) ELSE least(ep, lo) END AS nep
    FROM ({step})"""
    table = f"""w_sar AS (
  SELECT code, date, rn, CAST(1.0 AS DOUBLE) AS side, CAST(0.0 AS DOUBLE) AS st, CAST(0.0 AS DOUBLE) AS ep, CAST({acc} AS DOUBLE) AS af,
         low AS pl, high AS ph, CAST(NULL AS DOUBLE) AS shown FROM s WHERE rn = 1
  UNION ALL
  SELECT code, date, rn, CASE WHEN flip THEN -side ELSE side END,
    CASE WHEN flip AND side > 0 OR NOT flip AND side < 0 THEN greatest(shown + naf * (nep - shown), ph, hi)
         ELSE least(shown + naf * (nep - shown), pl, lo) END,
    nep, naf, lo, hi, shown
  FROM ({moved}))"""
    return [table, window_table("i_sar", {"sar": "shown"}, "w_sar")], ["sar"]


def t_willr(n=14):
    ll, hh = f"min(low) {over(n)}", f"max(high) {over(n)}"
    return [window_table("i_willr", {f"willr{n}": since(n, zdiv(f"{hh} - c", f"{hh} - {ll}", "-100.0"))})], [f"willr{n}"]


def t_tr():
    return [window_table("i_tr", {"tr": "trv", "vl": "trv / tp * 100.0"}, inner=RANGES)], ["tr", "vl"]


def t_atr(n=14):
    states = {"a": wilder("r.a", "(greatest(b.high, b.pc) - least(b.low, b.pc))", n)}
    inner = "(SELECT w.code, w.date, w.rn, w.a, s.c FROM w_atr w JOIN s USING (code, date))"
    cols = {"atr": since(n + 1, "a"), "natr": since(n + 1, "CASE WHEN c = 0 THEN 0.0 ELSE a / c * 100.0 END")}
    return [walk("w_atr", states), window_table("i_atr", cols, inner=inner)], list(cols)


def t_ret_index():
    return [window_table("i_ret", {"ret_index": "ri"})], ["ret_index"]


def t_vol():
    col = f"CASE WHEN count(ri) {over(250)} >= 50 THEN stddev_samp(ri) {over(250)} * sqrt(250.0) END"
    return [window_table("i_vol", {"vol": col})], ["vol"]


def t_volume_rate():
    p = "OVER (PARTITION BY code)"
    vr = f"(volume / max(volume) {p})"
    cols = {"v_rate": f"{vr} * 50.0", "v_rate_p": f"{vr} * ((max(high) {p} - min(low) {p}) / 4.0) + min(low) {p}"}
    return [window_table("i_vrate", cols)], list(cols)


TABLES = {
    "sma": t_sma, "ewma": t_ewma, "rsi": t_rsi, "mfi": t_mfi, "roc": t_roc, "cci": t_cci, "ultosc": t_ultosc,
    "stoch": t_stoch, "stochf": t_stochf, "macd": t_macd, "mom": t_mom, "bbands": t_bbands, "sar": t_sar,
    "willr": t_willr, "tr": t_tr, "atr": t_atr, "natr": t_atr, "ret_index": t_ret_index, "vol": t_vol,
    "volume_rate": t_volume_rate,
}


def _table_name(cte: str) -> str:
    return cte.split(" AS ")[0]


def indicator_sql(name: str) -> str:
    ctes, cols = TABLES[name]()
    if name in ("atr", "natr"):
        cols = [name]
    body = f"SELECT code, date, {rnds(cols)} FROM {_table_name(ctes[-1])}"
    return query(body, BARS, VALID, *series("valid"), *ctes, recursive=True)


def all_indicators() -> tuple[list[str], str]:
    """CTEs of every indicator and the joined enriched table ``ti`` (code, date, columns)."""
    ctes, joins, seen = [], [], set()
    for make in TABLES.values():
        if make in seen:
            continue
        seen.add(make)
        parts, cols = make()
        ctes += parts
        joins.append((_table_name(parts[-1]), cols))
    cols = [f"{t}.{c}" for t, cs in joins for c in cs]
    # The joins read materialised results so that no recursion runs twice.
    ctes = [c.replace(" AS (", " AS MATERIALIZED (", 1) if c.startswith("i_") else c for c in ctes]
    joined = " ".join(f"JOIN {t} USING (code, date)" for t, _ in joins)
    ctes.append(f"ti AS MATERIALIZED (SELECT s.*, {', '.join(cols)} FROM s {joined})")
    return ctes, "ti"


# ---- reports ---------------------------------------------------------------------------------


def pyint(expr: str) -> str:
    return f"CAST(trunc({expr}) AS BIGINT)"


RATIO = "round((1.0 + change) / close * 100.0, 2)"


def summary_sql(span: int, screening: str, ti_ctes: list[str], source: str, limit: str = "") -> str:
    figures = f"""figures AS (
  SELECT *, close - start AS change FROM (
    SELECT code, date, {pyint('open')} AS open, {pyint('high')} AS high, {pyint('low')} AS low,
      {pyint('adj_close')} AS close, {pyint('lead_start')} AS start, {pyint(screening)} AS {screening}, last_date FROM (
      SELECT *, lag(adj_close, {span}) {LAG} AS lead_start, max(date) OVER (PARTITION BY code) AS last_date FROM {source})
    WHERE date = last_date))"""
    body = f"""SELECT code, open, high, low, close, change, {rnd(RATIO, 'ratio')}, {screening}, name
FROM figures JOIN symbols USING (code) WHERE last_date >= DATE '{ASOF}' - 10 AND NOT ({IS_INDEX}) {limit}"""
    return query(body, BARS, VALID, KEPT.format(days=240), *ti_ctes, SUPPLIERS, figures, recursive=True)


def placed(report: str, by: str = "ratio DESC") -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {by} NULLS LAST, code) AS rank FROM ({report})"


def screening_sql(span: int, key: str, limit: str = "") -> str:
    ctes, _ = t_rsi()
    ctes = [*series("kept"), *ctes, "t AS (SELECT s.*, rsi9, rsi14 FROM s JOIN i_rsi USING (code, date))"]
    return summary_sql(span, key, ctes, "t", limit)


# ---- features and models ----------------------------------------------------------------------

INDEX = "ix AS MATERIALIZED (SELECT code, date, ri AS x, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS pos, least(count(*) OVER (PARTITION BY code), {span}) AS reach, first_value(c) OVER (PARTITION BY code ORDER BY date) AS base FROM s)"
WINDOWS = "win AS MATERIALIZED (SELECT code, date, pos, reach, x, base, list(x) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS f, list(x) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS g FROM ix)"
CLASS = "cls AS MATERIALIZED (SELECT code, date, f, CAST(f[14] < x AS INTEGER) AS label FROM win WHERE pos >= 2 AND pos <= reach - 14)"
VALUE = "val AS MATERIALIZED (SELECT code, date, f, x AS label FROM win WHERE pos >= 1 AND pos <= reach - 14)"
SCORE = "score AS MATERIALIZED (SELECT code, date, g AS f, base FROM win WHERE pos = 1 AND len(g) = 14)"


def learning(source: str = "valid", span: int = 135) -> list[str]:
    return [*series(source), INDEX.format(span=span), WINDOWS, CLASS, VALUE, SCORE]


def features_sql(table: str, label: str | None, span: int = 135) -> str:
    extra = f", {label}" if label else ""
    body = f"""SELECT code, date, CAST(len(f) AS INTEGER) AS n, {rnd('f[1]', 'oldest')}, {rnd('f[14]', 'newest')},
  {rnd('list_sum(f)', 'total')}{extra} FROM {table}"""
    return query(body, BARS, VALID, *learning(span=span))


def eliminate(n: int) -> list[str]:
    """Solve the n x (n + 1) systems ``a`` of table m0; the solutions are the last columns in table m<n>."""
    return [
        f"m{k} AS MATERIALIZED (SELECT code, [[CASE WHEN i = {k} THEN a[i][j] / a[{k}][{k}] "
        f"ELSE a[i][j] - a[i][{k}] * a[{k}][j] / a[{k}][{k}] END for j in range(1, {n + 2})] for i in range(1, {n + 1})] AS a FROM m{k - 1})"
        for k in range(1, n + 1)
    ]


def ridge_ctes(alpha: float = 1.0) -> list[str]:
    """Centred normal equations per symbol, solved by elimination without pivoting (they are definite)."""
    n = 14
    means = ", ".join(f"avg(f[{i}])" for i in range(1, n + 1))
    ctes = [
        f"mu AS MATERIALIZED (SELECT code, [{means}] AS m, avg(label) AS my FROM val GROUP BY code)",
        "cen AS MATERIALIZED (SELECT v.code, [v.f[i] - m[i] for i in range(1, 15)] AS z, v.label - my AS y FROM val v JOIN mu USING (code))",
    ]
    rows = []
    for i in range(1, n + 1):
        cells = [f"sum(z[{i}] * z[{j}])" + (f" + {alpha}" if i == j else "") for j in range(1, n + 1)]
        rows.append("[" + ", ".join([*cells, f"sum(z[{i}] * y)"]) + "]")
    ctes.append(f"m0 AS MATERIALIZED (SELECT code, [{', '.join(rows)}] AS a FROM cen GROUP BY code)")
    ctes += eliminate(n)
    ctes.append(
        f"ridge AS MATERIALIZED (SELECT score.code, score.date, my + list_sum([a[i][{n + 1}] * (f[i] - m[i]) for i in range(1, {n + 1})]) AS p, base "
        f"FROM score JOIN m{n} USING (code) JOIN mu USING (code))"
    )
    return ctes


def ridge_sql(span: int = 135) -> str:
    body = f"SELECT code, date, {rnd('p * base', 'prediction')} FROM ridge"
    return query(body, BARS, VALID, *learning(span=span), *ridge_ctes())


def nb_ctes(kind: str) -> list[str]:
    stat = {
        "gaussian": ("avg(f[{i}])", "var_pop(f[{i}])"),
        "multinomial": ("sum(f[{i}])", "sum(f[{i}])"),
        "bernoulli": ("sum(CASE WHEN f[{i}] > 0 THEN 1.0 ELSE 0.0 END)", "count(*)"),
    }[kind]
    a, b = ("[" + ", ".join(t.format(i=i) for i in range(1, 15)) + "]" for t in stat)
    ctes = [
        f"st AS (SELECT code, label, count(*) AS n, {a} AS a, {b} AS b FROM cls GROUP BY code, label)",
        "nb0 AS (SELECT *, ln(n / sum(n) OVER (PARTITION BY code)) AS prior FROM st)",
    ]
    if kind == "gaussian":
        ov = ", ".join(f"var_pop(f[{i}])" for i in range(1, 15))
        ctes.append(f"ov AS (SELECT code, 1e-9 * greatest({ov}) AS eps FROM cls GROUP BY code)")
        ll = "prior - 0.5 * list_sum([ln(2.0 * pi() * (b[i] + eps)) + power(score.f[i] - a[i], 2) / (b[i] + eps) for i in range(1, 15)])"
    elif kind == "multinomial":
        ctes.append("ov AS (SELECT DISTINCT code FROM cls)")
        ll = "prior + list_sum([score.f[i] * ln((a[i] + 1.0) / (list_sum(a) + 14.0)) for i in range(1, 15)])"
    else:
        ctes.append("ov AS (SELECT DISTINCT code FROM cls)")
        ll = "prior + list_sum([CASE WHEN score.f[i] > 0 THEN ln((a[i] + 1.0) / (n + 2.0)) ELSE ln(1.0 - (a[i] + 1.0) / (n + 2.0)) END for i in range(1, 15)])"
    ctes.append(
        f"nb AS MATERIALIZED (SELECT code, max(date) AS date, arg_max(label, ROW(ll, -label)) AS prediction FROM ("
        f"SELECT score.code, score.date, label, {ll} AS ll FROM score JOIN nb0 USING (code) JOIN ov USING (code)) GROUP BY code)"
    )
    return ctes


def nb_sql(kind: str) -> str:
    return query("SELECT code, date, prediction FROM nb", BARS, VALID, *learning(), *nb_ctes(kind))


def discriminant_sql() -> str:
    """Pooled within-class covariance (divisor n - 2), solved for the difference of the class means."""
    n = 14
    means = "[" + ", ".join(f"avg(f[{i}])" for i in range(1, n + 1)) + "]"
    rows = ", ".join(
        "[" + ", ".join([f"sum(z[{i}] * z[{j}]) / (count(*) - 2)" for j in range(1, n + 1)] + [f"any_value(gap[{i}])"]) + "]"
        for i in range(1, n + 1)
    )
    ctes = [
        f"cm AS MATERIALIZED (SELECT code, label, count(*) AS n, {means} AS m FROM cls GROUP BY code, label)",
        "two AS MATERIALIZED (SELECT a.code, a.n AS n0, b.n AS n1, [b.m[i] - a.m[i] for i in range(1, 15)] AS gap, "
        "[b.m[i] + a.m[i] for i in range(1, 15)] AS msum FROM cm a JOIN cm b ON a.code = b.code AND a.label = 0 AND b.label = 1)",
        "cen AS MATERIALIZED (SELECT c.code, gap, [f[i] - m[i] for i in range(1, 15)] AS z FROM cls c JOIN cm USING (code, label) JOIN two USING (code))",
        f"m0 AS MATERIALIZED (SELECT code, [{rows}] AS a FROM cen GROUP BY code)",
        *eliminate(n),
    ]
    body = f"""SELECT score.code, score.date, CAST(list_sum([a[i][{n + 1}] * (f[i] - msum[i] / 2.0) for i in range(1, {n + 1})]) + ln(n1 / n0) > 0 AS INTEGER) AS prediction
FROM score JOIN m{n} USING (code) JOIN two USING (code)"""
    return query(body, BARS, VALID, *learning(), *ctes)


def tree_ctes(depth: int = 5, trees: int = 1, weight: str = "1", draw: str | None = None) -> list[str]:
    """Trees of all symbols, level by level; the scored window rides along with weight 0.

    ``weight`` is a sample's weight in tree ``t``; ``draw`` orders the features ``f`` of a node.
    """
    last = f"ROW({draw}, f, gain, -t)" if draw else "ROW(gain, -f, -t)"
    ctes = [
        f"""g0 AS MATERIALIZED (
  SELECT code, t, sid, {weight} AS w, y, x, CAST(1 AS BIGINT) AS node FROM (
    SELECT code, date, row_number() OVER () AS sid, label AS y, [CAST(CAST(v AS FLOAT) AS DOUBLE) for v in f] AS x FROM cls), range(0, {trees}) AS ts(t)
  UNION ALL SELECT code, t, -1, 0, 0, [CAST(CAST(v AS FLOAT) AS DOUBLE) for v in f], 1 FROM score, range(0, {trees}) AS ts(t))"""
    ]
    for d in range(1, depth + 1):
        ctes.append(f"""cut{d} AS MATERIALIZED (
  SELECT code, tree, node, arg_max(ROW(f, t), {last}) AS best FROM (
    SELECT code, tree, node, f, (v + nv) / 2.0 AS t,
      (p * p + (n - p) * (n - p)) / n + ((tp - p) * (tp - p) + ((tn - n) - (tp - p)) * ((tn - n) - (tp - p))) / (tn - n) AS gain
    FROM (
      SELECT code, t AS tree, node, f, v, lead(v) OVER o AS nv,
        CAST(sum(w) OVER (o RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS n,
        CAST(sum(w * y) OVER (o RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS p,
        CAST(sum(w) OVER (PARTITION BY code, t, node, f) AS DOUBLE) AS tn,
        CAST(sum(w * y) OVER (PARTITION BY code, t, node, f) AS DOUBLE) AS tp
      FROM (SELECT code, t, node, w, y, f, x[f + 1] AS v FROM g{d - 1}, range(0, 14) AS fs(f) WHERE w > 0)
      WINDOW o AS (PARTITION BY code, t, node, f ORDER BY v))
    WHERE nv > v AND tp > 0 AND tp < tn)
  GROUP BY code, tree, node)""")
        ctes.append(f"""g{d} AS MATERIALIZED (
  SELECT g.code, g.t, sid, w, y, x, CASE WHEN best IS NULL THEN g.node
    ELSE g.node * 2 + CAST(x[best[1] + 1] > best[2] AS BIGINT) END AS node
  FROM g{d - 1} g LEFT JOIN cut{d} c ON c.code = g.code AND c.tree = g.t AND c.node = g.node)""")
    ctes.append(f"""tree AS MATERIALIZED (
  SELECT q.code, max(score.date) AS date, CAST(avg(q.share) > 0.5 + 1e-12 AS INTEGER) AS prediction FROM (
    SELECT code, sid, sum(w * y) OVER (PARTITION BY code, t, node) / sum(w) OVER (PARTITION BY code, t, node) AS share FROM g{depth}) q
  JOIN score ON score.code = q.code WHERE sid = -1 AND share IS NOT NULL GROUP BY q.code)""")
    return ctes


def forest_sql(trees: int = 10, seed: int = 7) -> str:
    """Weights and drawn features from the digits of a digest."""
    from barloom.operators.trees import poisson_steps

    digits = f"substr(md5(code || '|' || strftime(date, '%Y-%m-%d') || '|' || t || '|{seed}'), 1, 8)"
    weight = "(" + " + ".join(f"CAST({digits} > '{step}' AS INTEGER)" for step in poisson_steps()) + ")"
    draw = f"substr(md5(code || '|' || tree || '|' || node || '|{seed}'), 1 + 2 * f, 2)"
    return query("SELECT code, date, prediction FROM tree", BARS, VALID, *learning(), *tree_ctes(5, trees, weight, draw))


def boosted_sql(rounds: int = 50) -> str:
    """Stumps round by round; a symbol whose stump makes no mistake stops there."""
    eps = "2.220446049250313e-16"
    ctes = [
        "b_x AS MATERIALIZED (SELECT code, row_number() OVER () AS sid, label AS y, [CAST(CAST(v AS FLOAT) AS DOUBLE) for v in f] AS x FROM cls)",
        "b_v AS MATERIALIZED (SELECT code, sid, y, f, x[f + 1] AS v FROM b_x, range(0, 14) AS fs(f))",
        "b_w0 AS MATERIALIZED (SELECT code, sid, y, 1.0 / CAST(count(*) OVER (PARTITION BY code) AS DOUBLE) AS w, false AS done FROM b_x)",
    ]
    for k in range(1, rounds + 1):
        ctes.append(f"""b_s{k} AS MATERIALIZED (
  SELECT code, max(tp) / max(tn) AS whole, arg_max(ROW(f, t, lp / ln, rp / rn), ROW(gain, -f, -t)) FILTER (t IS NOT NULL AND tp > 0 AND tp < tn) AS s FROM (
    SELECT *, CASE WHEN nv > v THEN (v + nv) / 2.0 END AS t,
      round((lp * lp + (ln - lp) * (ln - lp)) / ln + (rp * rp + (rn - rp) * (rn - rp)) / rn, 11) AS gain FROM (
      SELECT b.code, f, v, lead(v) OVER o AS nv, sum(w) OVER (o ROWS UNBOUNDED PRECEDING) AS ln, sum(w * b.y) OVER (o ROWS UNBOUNDED PRECEDING) AS lp,
        sum(w) OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rn, sum(w * b.y) OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rp,
        sum(w) OVER (PARTITION BY b.code, f) AS tn, sum(w * b.y) OVER (PARTITION BY b.code, f) AS tp
      FROM b_v b JOIN b_w{k - 1} p ON p.sid = b.sid WHERE NOT done WINDOW o AS (PARTITION BY b.code, f ORDER BY v, b.sid)))
  GROUP BY code)""")
        ctes.append(f"""b_w{k} AS MATERIALIZED (
  SELECT code, sid, y, m / sum(m) OVER (PARTITION BY code) AS w, wrong <= 0 AS done FROM (
    SELECT *, w * exp(CASE WHEN y > 0.5 THEN -0.5 ELSE 0.5 END * ln(greatest(least(p, 1.0 - {eps}), {eps}) / (1.0 - greatest(least(p, 1.0 - {eps}), {eps})))) AS m,
      sum(CASE WHEN (p > 0.5) <> (y > 0.5) THEN w ELSE 0 END) OVER (PARTITION BY code) AS wrong FROM (
      SELECT w.code, w.sid, w.y, w.w, CASE WHEN s IS NULL THEN whole WHEN x[s[1] + 1] > s[2] THEN s[4] ELSE s[3] END AS p
      FROM b_w{k - 1} w JOIN b_x x ON x.sid = w.sid JOIN b_s{k} t ON t.code = w.code WHERE NOT w.done)))""")
    votes = " UNION ALL ".join(
        f"SELECT code, whole, s FROM b_s{k}" for k in range(1, rounds + 1)
    )
    share = "CASE WHEN s IS NULL THEN whole WHEN CAST(CAST(f[s[1] + 1] AS FLOAT) AS DOUBLE) > s[2] THEN s[4] ELSE s[3] END"
    body = f"""SELECT code, date, CAST(sum(ln(p / (1.0 - p))) > 0 AS INTEGER) AS prediction FROM (
  SELECT score.code, score.date, greatest(least({share}, 1.0 - {eps}), {eps}) AS p FROM score JOIN ({votes}) v ON v.code = score.code) GROUP BY code, date"""
    return query(body, BARS, VALID, *learning(), *ctes)


def lasso_sql(alpha: float, sweeps: int = 300) -> str:
    """Cyclic coordinate descent on the centred sums, one coordinate a step."""
    n = 14
    means = ", ".join(f"avg(f[{i}])" for i in range(1, n + 1))
    gram = "[" + ", ".join("[" + ", ".join(f"sum(z[{i}] * z[{j}])" for j in range(1, n + 1)) + "]" for i in range(1, n + 1)) + "]"
    moment = "[" + ", ".join(f"sum(z[{i}] * y)" for i in range(1, n + 1)) + "]"
    rho = "(q.b[k] - list_sum([q.g[k][j] * w[j] for j in range(1, 15)]) + q.g[k][k] * w[k])"
    return query(
        f"SELECT score.code, score.date, {rnd(f'(my + list_sum([w[i] * (f[i] - m[i]) for i in range(1, {n + 1})])) * base', 'prediction')} "
        f"FROM score JOIN descent USING (code) JOIN mu USING (code) WHERE step = {n * sweeps}",
        BARS, VALID, *learning(),
        f"mu AS MATERIALIZED (SELECT code, [{means}] AS m, avg(label) AS my FROM val GROUP BY code)",
        "cen AS MATERIALIZED (SELECT v.code, [v.f[i] - m[i] for i in range(1, 15)] AS z, v.label - my AS y FROM val v JOIN mu USING (code))",
        f"sums AS MATERIALIZED (SELECT code, {gram} AS g, {moment} AS b, {alpha!r} * count(*) AS penalty FROM cen GROUP BY code)",
        f"""descent AS (
  SELECT code, 0 AS step, [CAST(0.0 AS DOUBLE) for i in range(0, 14)] AS w FROM sums
  UNION ALL
  SELECT code, step + 1, [CASE WHEN i <> k THEN w[i] WHEN d = 0 THEN 0.0 ELSE sign(rho) * greatest(abs(rho) - penalty, 0.0) / d END for i in range(1, 15)]
  FROM (SELECT r.code, step, w, k, q.penalty, q.g[k][k] AS d, {rho} AS rho FROM (SELECT *, step % 14 + 1 AS k FROM descent WHERE step < {n * sweeps}) r JOIN sums q ON q.code = r.code))""",
        recursive=True,
    )


def tree_sql(span: int = 135) -> str:
    return query("SELECT code, date, prediction FROM tree", BARS, VALID, *learning(span=span), *tree_ctes())


# ---- the statements ----------------------------------------------------------------------------

V = rnds(VALUES)
DAY = "CAST(ts AS DATE)"
BDAY = f"{DAY} - CAST(greatest(isodow(ts) - 5, 0) AS INTEGER)"


def filled_sql(bars: str, step: str, where: str) -> str:
    """Bars with all bins between a symbol's first and last one, from a calendar of its own."""
    return f"""WITH b AS MATERIALIZED ({bars}), d AS (
  SELECT code, CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL {step})) AS DATE) AS date FROM b GROUP BY code)
SELECT d.code, d.date, b.* EXCLUDE (code, date) FROM d LEFT JOIN b ON b.code = d.code AND b.date = d.date {where.replace("date", "d.date")}"""


def resample_sql(bucket: str, where: str = "", ticks: str = "event_type") -> str:
    body = f"""SELECT code, {bucket} AS date, {rnd('arg_min(value, ROW(ts, seq))', 'open')}, {rnd('max(value)', 'high')},
  {rnd('min(value)', 'low')}, {rnd('arg_max(value, ROW(ts, seq))', 'close')} FROM ticks GROUP BY ALL {where}"""
    return query(body, TICKS.replace("event_type AS", f"CAST({ticks} AS VARCHAR) AS"))


def period_sql(unit: str, where: str = "") -> str:
    body = f"""SELECT code, CAST(date_trunc('{unit}', date) AS DATE) AS date, {rnd('arg_min(open, date)', 'open')},
  {rnd('max(high)', 'high')}, {rnd('min(low)', 'low')}, {rnd('arg_max(close, date)', 'close')},
  {rnd('sum(volume)', 'volume')}, {rnd('arg_max(adj_close, date)', 'adj_close')} FROM bars {where} GROUP BY ALL"""
    return query(body, BARS)


ALIGNED = """aligned AS MATERIALIZED (
  SELECT d.code, d.date, open, high, low, close, volume, adj_close FROM (
    SELECT code, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT code, min(date) AS lo, max(date) AS hi FROM bars GROUP BY code)) d
  LEFT JOIN bars b ON b.code = d.code AND b.date = d.date WHERE isodow(d.date) <= 5)"""

OLD = f"old AS (SELECT * REPLACE (CASE WHEN volume <= 40 THEN volume END AS volume) FROM bars WHERE date < DATE '{SPLIT}')"
NEW = "new AS (SELECT code, date, " + ", ".join(f"{c} * 2.0 AS {c}" for c in VALUES) + " FROM bars)"
NEXT = "CAST({d} + CASE isodow({d}) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE)"
MARK = f"mark AS (SELECT code, {NEXT.format(d='max(date)')} AS next_date FROM old GROUP BY code)"
FRESH = "fresh AS (SELECT new.* FROM new LEFT JOIN mark USING (code) WHERE next_date IS NULL OR date >= next_date)"


#: What each chart shows: columns as they are, and scaled ones as (series, expression).
OHLC = ["open", "high", "low", "close"]
MEANS = ["ewma25", "ewma50", "ewma75"]
OSCILLATORS = ["rsi9", "rsi14", "v_rate"], [("vl", "vl * 5")]
CHARTS = {
    (1, 1): ([*OHLC, *MEANS, "ewma200", "v_rate_p"], [], []),
    (1, 3): ([*OHLC, *MEANS, "ewma5", "sar", "upperband", "lowerband", "v_rate_p"], [], []),
    (2, 1): ([*OHLC, *MEANS, "ewma200"], *OSCILLATORS),
    (2, 2): ([*OHLC, *MEANS, "ewma5", "sar"], [*OSCILLATORS[0], "mfi14", "ultosc", "slowk", "slowd"], OSCILLATORS[1]),
    (2, 3): (
        [*OHLC, *MEANS, "ewma5", "sar", "upperband", "lowerband"],
        [*OSCILLATORS[0], "mfi14", "ultosc", "slowk", "slowd"],
        [*OSCILLATORS[1], ("roc10", "roc10 + 50"), ("roc25", "roc25 + 50"), ("willr14", "willr14 + 100")],
    ),
}


def chart_sql(axis: int, complexity: int, days: int) -> str:
    ctes, table = all_indicators()
    price, plain, scaled = CHARTS[axis, complexity]
    shown = [("price", c, c) for c in price] + [("oscillator", c, c) for c in plain] + [("oscillator", c, e) for c, e in scaled]
    rows = " UNION ALL ".join(f"SELECT code, date, '{p}' AS panel, '{c}' AS series, {e} AS value FROM {table}" for p, c, e in shown)
    body = f"SELECT code, date, panel, series, {rnd('value')} FROM ({rows}) WHERE value IS NOT NULL"
    return query(body, BARS, VALID, KEPT.format(days=days), *series("kept"), *ctes, recursive=True)


def forecast_ctes(classifier: str) -> list[str]:
    model = tree_ctes() if classifier == "tree" else nb_ctes("gaussian")
    return [*learning("kept"), *model, *ridge_ctes(), f"""marks AS (
  SELECT l.code, l.date, prediction AS classified, {pyint('p * ridge.base')} AS predicted
  FROM {'tree' if classifier == 'tree' else 'nb'} l JOIN ridge ON ridge.code = l.code)"""]


def full_summary_sql() -> str:
    return query(
        f"""SELECT code, open, high, low, close, change, {rnd(RATIO, 'ratio')}, CAST(classified AS BIGINT) AS trend, predicted AS pred, name
FROM (SELECT *, close - start AS change FROM (
  SELECT k.code, k.date, {pyint('k.open')} AS open, {pyint('k.high')} AS high, {pyint('k.low')} AS low, {pyint('k.adj_close')} AS close,
    {pyint('k.prev')} AS start, classified, predicted
  FROM (SELECT *, lag(adj_close) {LAG} AS prev, max(date) OVER (PARTITION BY code) AS last_date FROM kept) k
  LEFT JOIN marks m ON m.code = k.code AND m.date = k.date WHERE k.date = last_date)) JOIN symbols USING (code)
WHERE date >= DATE '{ASOF}' - 10""",
        BARS, VALID, KEPT.format(days=240), *forecast_ctes("nb"), SUPPLIERS,
    )


def caption_sql() -> str:
    num = "format('{{:,}}', {0})".format
    cap = (
        f"name || '(' || code || ')  ' || '2001/11/04' || chr(10) || '終値:' || {num('close')} || ' (' || "
        f"(CASE WHEN change >= 0 THEN '+' ELSE '' END) || change || ', ' || CAST(ratio AS VARCHAR) || '%)' || chr(10) || "
        f"' 出来高:' || {num('volume')} || ' 最高:' || {num('highest')} || ' 最安:' || {num('lowest')} || "
        f"' 分類器予測:' || trend || ' 回帰分析:' || {num('pred')}"
    )
    return query(
        f"""SELECT code, last_date, volume, close, change, {rnd('ratio')}, highest, lowest, trend, pred, name AS title, {cap} AS caption FROM (
  SELECT *, {RATIO} AS ratio FROM (SELECT *, close - start AS change FROM (
    SELECT k.code, k.date AS last_date, {pyint('volume')} AS volume, {pyint('adj_close')} AS close, {pyint('prev')} AS start,
      {pyint('hi')} AS highest, {pyint('lo')} AS lowest, CASE WHEN classified = 0 THEN '↓' ELSE '↑' END AS trend, predicted AS pred
    FROM (SELECT *, lag(adj_close) {LAG} AS prev, max(date) OVER p AS last_date, max(high) OVER p AS hi, min(low) OVER p AS lo
          FROM kept WINDOW p AS (PARTITION BY code)) k
    JOIN marks m ON m.code = k.code AND m.date = k.date WHERE k.date = last_date))) JOIN symbols USING (code)""",
        BARS, VALID, KEPT.format(days=240), *forecast_ctes("nb"), SUPPLIERS,
    )


def analysed_sql(*source: str, days: int = 240) -> str:
    ctes, table = all_indicators()
    learn = [c for c in forecast_ctes("tree") if not c.startswith("s AS")]
    body = f"""SELECT t.code, t.date, {rnds(VALUES)}, {rnds(STANDARD_COLUMNS)}, classified, predicted
FROM {table} t LEFT JOIN marks m ON m.code = t.code AND m.date = t.date"""
    return query(body, *(source or [BARS]), VALID, KEPT.format(days=days), *series("kept"), *ctes, *learn, recursive=True)


DAILY = [
    BARS.replace("bars AS", "whole AS", 1),
    f"start AS (SELECT * FROM whole WHERE date < DATE '{SPLIT}')",
    f"mark AS (SELECT code, {NEXT.format(d='max(date)')} AS next_date FROM start GROUP BY code)",
    """bars AS MATERIALIZED (SELECT * FROM start UNION ALL
  SELECT whole.* FROM whole LEFT JOIN mark USING (code)
  WHERE CAST(code AS INTEGER) % 3 <> 0 AND (next_date IS NULL OR date >= next_date))""",
]


MODELS_RUN = [DAILY[0], f"bars AS MATERIALIZED (SELECT * FROM whole WHERE CAST(code AS INTEGER) % 3 <> 0 OR date < DATE '{SPLIT}')"]


def enriched_sql() -> str:
    ctes, table = all_indicators()
    body = f"SELECT code, date, {rnds(STANDARD_COLUMNS)} FROM {table}"
    return query(body, BARS, VALID, *series("valid"), *ctes, recursive=True)


def corr_sql(n: int = 5) -> str:
    # The definition itself: correlate over the union of both date lists, then keep own dates.
    return query(
        f"""SELECT code, date, {rnd('v', 'rolling_corr')} FROM (
  SELECT code, date, own, CASE WHEN count(c + r) {over(n)} = {n} AND stddev_pop(c) {over(n)} > 0 AND stddev_pop(r) {over(n)} > 0
    THEN corr(c, r) {over(n)} END AS v FROM both_dates) WHERE own""",
        BARS, ALIGNED,
        f"""padded AS MATERIALIZED (SELECT code, date, p / lag(p) {LAG} - 1 AS c, p AS pad FROM (
  SELECT code, date, last_value(adj_close IGNORE NULLS) {LAG} AS p FROM aligned))""",
        "ref AS MATERIALIZED (SELECT date, c AS r FROM padded WHERE code = '0')",
        """both_dates AS MATERIALIZED (
  SELECT d.code, d.date, padded.code IS NOT NULL AS own, c, r FROM (
    SELECT code, date FROM padded UNION SELECT code, date FROM (SELECT DISTINCT code FROM padded), ref) d
  LEFT JOIN padded ON padded.code = d.code AND padded.date = d.date LEFT JOIN ref ON ref.date = d.date)""",
    )


def streamed_sql(where: str) -> str:
    parts = [t_ewma((5,)), t_rsi((14,)), t_atr(), t_macd(), t_bbands(), t_sar()]
    first, *others = [_table_name(c[-1]) for c, _ in parts]
    joined = first + "".join(f" JOIN {t} USING (code, date)" for t in others)
    body = f"SELECT code, date, {rnds([c for _, cols in parts for c in cols])} FROM {joined} {where}"
    return query(body, BARS, VALID, *series("valid"), *[c for ctes, _ in parts for c in ctes], recursive=True)


def statements() -> dict[str, str]:
    b = [BARS]
    bv = [BARS, VALID]
    out = {name: indicator_sql(name) for name in TABLES}
    out |= {f"stoch_average_{t}": average_sql((t, t), (4, 3), 6) for t in (1, 2, 3, 4, 5, 6, 8)}
    out["stoch_average_mixed"] = average_sql((2, 6), (3, 5), None)
    report = f"SELECT code, close, {rnd(RATIO, 'ratio')}"
    plain = query(f"SELECT code, date, {V} FROM bars", *b)
    sma_rsi = screening_sql(1, "rsi14")
    out |= {
        "flagship_report": sma_rsi,
        "bars_from_ticks": plain,
        "history_round_trip": plain,
        "price_csv_round_trip": plain,
        "exported_round_trip": plain,
        "bucketed_indicators": query(
            f"SELECT code, date, {V}, {rnds(['sma25', 'rsi14'])} FROM s JOIN i_sma USING (code, date) JOIN i_rsi USING (code, date)",
            *bv, *series("valid"), *t_sma((25,))[0], *t_rsi((14,))[0], recursive=True,
        ),
        "symbol_list_round_trip": query(
            "SELECT code, name, CAST(NULL AS VARCHAR) AS fullname, CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS \"group\" FROM symbols",
            SUPPLIERS,
        ),
        "report_round_trip": sma_rsi,
        "report_snapshots": f"SELECT d.snapshot_date, code, close, ratio FROM ({sma_rsi}) r, "
        f"(SELECT DATE '{SPLIT}' AS snapshot_date UNION ALL SELECT DATE '{ASOF}') d",
        "raw_history": query(f"SELECT code, date, {V} FROM aligned", *b, ALIGNED),
        "date_range_default": query(
            f"SELECT code, date, {V} FROM bars WHERE date BETWEEN DATE '{ASOF}' - 365 AND DATE '{ASOF}'", *b
        ),
        "date_range_given": f"SELECT * FROM ({resample_sql(BDAY)}) WHERE date BETWEEN DATE '2024-01-08' AND DATE '{EVENT_ASOF}'",
        "code_routing": query(f"SELECT code, {IS_INDEX} AS is_index FROM listed", LISTED),
        "missing_history": query("SELECT code, name FROM listed WHERE code NOT IN (SELECT code FROM bars)", *b, LISTED),
        "listed_enriched": query(
            f"SELECT code, date, {rnd('ri', 'ret_index')}, least(name, CASE WHEN TRY_CAST(code AS INTEGER) % 2 = 0 THEN 'A second ' || name END) AS name FROM s JOIN listed USING (code)",
            *bv, *series("valid"), LISTED,
        ),
        "business_day_align": query(f"SELECT code, date, {V} FROM aligned", *b, ALIGNED),
        "valid_bars": query(f"SELECT code, date, {V} FROM valid", *bv),
        "drop_incomplete": query(f"SELECT code, date, {V} FROM old WHERE volume IS NOT NULL", *b, OLD),
        "last_240_bars": query(f"SELECT code, date, {V} FROM kept", *bv, KEPT.format(days=240)),
        "upsert_cells": query(
            "SELECT coalesce(old.code, new.code) AS code, coalesce(old.date, new.date) AS date, "
            + ", ".join(rnd(f"coalesce(old.{c}, new.{c})", c) for c in VALUES)
            + " FROM old FULL OUTER JOIN new ON old.code = new.code AND old.date = new.date",
            *b, OLD, NEW,
        ),
        "next_business_day": query(
            f"SELECT code, max(date) AS last_date, {NEXT.format(d='max(date)')} AS next_date FROM bars GROUP BY code", *b
        ),
        "new_rows": query(f"SELECT code, date, {V} FROM fresh", *b, OLD, NEW, MARK, FRESH),
        "changed_codes": query("SELECT DISTINCT code FROM fresh", *b, OLD, NEW, MARK, FRESH),
        "resample_ticks": resample_sql(BDAY),
        "resample_ticks_weekly": resample_sql("CAST(date_trunc('week', ts) AS DATE)"),
        "resample_weekly": period_sql("week"),
        "resample_monthly": period_sql("month"),
        "ohlc_columns": resample_sql(BDAY),
        **{f"resample_ticks_{n}": filled_sql(resample_sql(b, ticks="user_id"), f, w) for n, b, f, w in (
            ("filled", BDAY, "1 DAY", "WHERE isodow(date) <= 5"),
            ("daily_filled", DAY, "1 DAY", ""),
            ("weekly_filled", "CAST(date_trunc('week', ts) AS DATE)", "7 DAYS", ""),
        )},
        **{f"resample_{n}_filled": filled_sql(period_sql(u, "WHERE volume >= 49"), f, "") for n, u, f in (
            ("weekly", "week", "7 DAYS"), ("monthly", "month", "1 MONTH"),
        )},
        "quality_report": query(
            """SELECT code, CAST(sum(n) AS BIGINT) AS bars, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys,
  CAST(sum(lb) AS BIGINT) AS low_above_body, CAST(sum(hb) AS BIGINT) AS high_below_body, CAST(sum(mi) AS BIGINT) AS incomplete_rows,
  CAST(sum(we) AS BIGINT) AS weekend_rows FROM (
  SELECT code, date, count(*) AS n, count(*) FILTER (low > least(open, close)) AS lb, count(*) FILTER (high < greatest(open, close)) AS hb,
    count(*) FILTER (isodow(date) > 5) AS we, count(*) FILTER (gone) AS mi FROM (
    SELECT code, date, open, close, high, CASE WHEN volume > 80 THEN high * 2 ELSE low END AS low, volume > 70 AS gone FROM bars
    UNION ALL SELECT code, date, open, close, high, low, false FROM bars WHERE volume > 60) GROUP BY code, date) GROUP BY code""",
            *b,
        ),
        "last_cells": query(
            f"""SELECT code, max(date) FILTER (rd = 1) AS last_date, {rnd('max(adj_close) FILTER (rd = 1)', 'last_close')},
  max(date) FILTER (rd = 2) AS previous_date, {rnd('max(adj_close) FILTER (rd = 2)', 'previous_close')} FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS rd FROM valid) WHERE rd <= 2 GROUP BY code HAVING count(*) = 2""",
            *bv,
        ),
        "cell_lookup": query(f"SELECT code, date, {rnd('adj_close')} FROM bars WHERE date = DATE '2000-03-01'", *b),
        "exclude_indices": query(f"SELECT code, name FROM listed WHERE NOT ({IS_INDEX})", LISTED),
        "fresh_symbols": query(
            f"SELECT code, max(date) AS last_date FROM bars GROUP BY code HAVING max(date) >= DATE '{ASOF}' - 10", *b
        ),
        "last_change": query(
            f"""SELECT code, date, close, previous, change, {rnd(RATIO, 'ratio')} FROM (SELECT *, close - previous AS change FROM (
  SELECT code, date, {pyint('adj_close')} AS close, {pyint('prev')} AS previous FROM (
    SELECT *, lag(adj_close) {LAG} AS prev, max(date) OVER (PARTITION BY code) AS last_date FROM valid) WHERE date = last_date))""",
            *bv,
        ),
        "display_names": query(f"SELECT code, CASE WHEN {IS_INDEX} THEN name ELSE name || ' K.K.' END AS title FROM listed", LISTED),
        "chart_families": query(
            "SELECT DISTINCT code, CASE WHEN days > 300 THEN 'long' WHEN days <= 60 THEN 'short' ELSE 'chart' END AS chart, "
            "CAST(days AS INTEGER) AS days FROM bars, (VALUES (240), (600), (60), (0)) AS t(days)",
            *b,
        ),
        "short_history_errors": query(
            """SELECT code, count(*) AS bars, CASE WHEN count(*) < 15 THEN 'no sample for the classifier and the regressor'
  ELSE 'no sample for the classifier' END AS reason FROM (SELECT DISTINCT code, date_trunc('week', ts) FROM ticks) GROUP BY code HAVING count(*) < 16""",
            TICKS,
        ),
        "summary": placed(full_summary_sql()),
        "summary_10": placed(screening_sql(10, "rsi14")),
        "screening_rsi9": placed(screening_sql(1, "rsi9")),
        "screening_rsi14": placed(sma_rsi, "rsi14"),
        "ranking_top20": placed(sma_rsi) + " QUALIFY rank <= 20",
        "chart_series_main": chart_sql(2, 3, 240),
        "chart_series_long": chart_sql(1, 1, 600),
        "chart_series_short": chart_sql(2, 2, 60),
        "chart_series_price": chart_sql(1, 3, 240),
        "chart_series_plain": chart_sql(2, 1, 240),
        "chart_caption": caption_sql(),
        "rolling_corr": corr_sql(),
        "binary_class": features_sql("cls", "label"),
        "binary_class_90": features_sql("cls", "label", 90),
        "proportion_class": features_sql("val", rnd("label")),
        "scoring_window": features_sql("score", None),
        "ridge": ridge_sql(),
        "ridge_compat_last": ridge_sql(16),
        # With this penalty every weight is zero, which leaves the mean label.
        "lasso_large_penalty": query(
            f"SELECT score.code, score.date, {rnd('avg(label) * any_value(base)', 'prediction')} FROM score JOIN val USING (code) GROUP BY score.code, score.date",
            *bv, *learning(),
        ),
        "lasso": lasso_sql(1.0, 40),
        "lasso_small_penalty": lasso_sql(0.001),
        "random_forest": forest_sql(),
        "adaboost": boosted_sql(),
        "decision_tree": tree_sql(),
        "decision_tree_compat_last": tree_sql(16),
        "gaussian_nb": nb_sql("gaussian"),
        "multinomial_nb": nb_sql("multinomial"),
        "bernoulli_nb": nb_sql("bernoulli"),
        "discriminant": discriminant_sql(),
        "stored_model": nb_sql("gaussian"),
        "models_by_run": query(
            f"SELECT nb.code, nb.date, prediction, {rnd('p', 'value')} FROM nb JOIN ridge ON ridge.code = nb.code",
            *MODELS_RUN, VALID, *learning(), *nb_ctes("gaussian"), *ridge_ctes(),
        ),
        "stream_bars": f"""SELECT * FROM ({resample_sql(BDAY)}) WHERE CAST(date + 1 AS TIMESTAMP) <=
  (SELECT max(ts - to_days(CAST(greatest(isodow(ts) - 5, 0) AS INTEGER))) - INTERVAL 1 DAY FROM events WHERE value IS NOT NULL)""",
        "stream_upsert": query(
            "SELECT code, date, " + ", ".join(rnd(f"arg_min({c}, k) FILTER ({c} IS NOT NULL)", c) for c in VALUES)
            + " FROM (SELECT 0 AS k, * FROM old UNION ALL SELECT 1, * FROM new WHERE CAST(code AS INTEGER) % 2 = 1 "
            + "UNION ALL SELECT 2, code, date, " + ", ".join(f"{c} * 1.5" for c in VALUES) + " FROM new) GROUP BY code, date",
            *b, OLD, NEW,
        ),
        "stream_indicators": streamed_sql(""),
        "stream_indicators_stored": streamed_sql(f"WHERE date >= DATE '{STREAM_CUTS[0]}'"),
        "enriched_all": enriched_sql(),
        "analysed_240": analysed_sql(),
        "daily_run_history": query(f"SELECT code, date, {V} FROM bars", *DAILY),
        "daily_run_enriched": analysed_sql(*DAILY),
        "daily_run_whole": analysed_sql(days=10**9),
        "daily_run_earlier": analysed_sql(DAILY[0], DAILY[1].replace("start AS (", "bars AS MATERIALIZED (", 1)),
        "return_index_demo": query(
            f"SELECT code, date, {V}, {rnd('ri', 'ret_index')} FROM s", *bv, *series("valid")
        ),
    }
    return out
