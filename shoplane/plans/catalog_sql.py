"""The catalog's queries as SQL over the star-schema tables, for comparing results with another engine.

Everything here is text; nothing of it runs in a job. Decimals leave as doubles, dates and timestamps as text, as in
``catalog.portable``.
"""

from __future__ import annotations

from shoplane.contracts import (
    CATEGORY_PRICE_BOUNDS,
    ORDER_STATUSES,
    ORDERS,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    SEGMENTS,
    TABLES,
)
from shoplane.functions.scalars import DRAW_MODULUS, draw_constants
from shoplane.operators import decompose, defects, synth
from shoplane.plans.catalog import SEED, TRAFFIC
from shoplane.sources import star

AS_OF = "timestamp '2001-08-02 00:00:00'"

# The views, each after those it reads.
VIEWS = {
    "v_customers": """
select c_custkey as customer_id, c_name as full_name, concat(lower(c_name), '@example.com') as email,
  n_name as country, r_name as city, c_mktsegment as segment, timestamp '1994-01-01 00:00:00' as created_at
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "v_products": """
select p_partkey as product_id, concat('SKU-', cast(p_partkey as varchar)) as sku, p_name as name, p_type as category,
  cast(p_retailprice as decimal(10,2)) as unit_price,
  cast(cast(p_retailprice as decimal(10,2)) * cast(45 + p_partkey % 36 as decimal(4,0)) * cast(0.01 as decimal(3,2))
    as decimal(10,2)) as cost,
  timestamp '1994-01-01 00:00:00' as created_at
from part""",
    "v_orders": """
select o_orderkey as order_id, o_custkey as customer_id, p.product_id, cast(1 + o_orderkey % 6 as int) as quantity,
  p.unit_price, cast(p.unit_price * cast(1 + o_orderkey % 6 as int) as decimal(12,2)) as total_amount,
  case (o_orderkey + o_custkey) % 5 when 0 then 'placed' when 1 then 'shipped' when 2 then 'delivered'
    when 3 then 'returned' else 'cancelled' end as status,
  cast(o_orderdate as timestamp) as ordered_at
from (select *, o_orderkey % (select count(*) from part) as part_at from orders)
join v_products p on p.product_id = part_at""",
    "v_payments": """
select order_id as payment_id, order_id,
  case order_id % 5 when 0 then 'credit_card' when 1 then 'debit_card' when 2 then 'paypal'
    when 3 then 'bank_transfer' else 'wallet' end as method,
  total_amount as amount,
  case when status = 'returned' then 'refunded' when order_id % 3 = 0 then 'authorized' else 'captured' end as status,
  ordered_at as paid_at
from v_orders""",
    "d_orders": """
select order_id, case when order_id % 997 = 1 then null else customer_id end as customer_id, product_id,
  case when order_id % 991 = 2 then -5 else quantity end as quantity,
  case when order_id % 983 = 3 then cast(-49.99 as decimal(10,2)) else unit_price end as unit_price,
  case when order_id % 991 = 2 then cast(0 as decimal(12,2)) when order_id % 983 = 3 then cast(-49.99 as decimal(12,2))
    when order_id % 977 = 4 then cast(0 as decimal(12,2)) else total_amount end as total_amount,
  case when order_id % 971 = 5 then '<script>/0x00 status?' else status end as status, ordered_at
from v_orders
union all
select order_id + 100000000, customer_id, product_id, quantity, unit_price, total_amount, status, ordered_at
from v_orders where order_id % 967 = 6""",
    "d_payments": """
select payment_id, case when order_id % 953 = 7 then 999999999 else order_id end as order_id, method,
  case when order_id % 947 = 8 then cast(amount * cast(0.5 as decimal(2,1)) as decimal(12,2)) else amount end as amount,
  status, paid_at
from v_payments where order_id % 941 <> 9""",
    "l_orders": """
select *, ordered_at + cast(order_id % 4 as int) * interval 1 day as landed_at from d_orders""",
    "n_orders": """
select order_id, customer_id, product_id, quantity, unit_price,
  case when order_id % 97 = 3 then cast(0 as decimal(12,2)) else total_amount end as total_amount,
  case when order_id % 89 = 5 then 'cancelled' else status end as status, ordered_at
from v_orders where order_id % 101 <> 7
union all
select order_id + 200000000, customer_id, product_id, quantity, unit_price, total_amount, status, ordered_at
from v_orders where order_id % 103 = 9""",
}


def _texts(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


# The tables after both deliveries of change files.
VIEWS |= {
    "y_customers": """
select * replace (case when customer_id % 53 = 4 then 'MACHINERY' else segment end as segment) from v_customers""",
    "y_products": """
select * replace (case when product_id % 41 = 7 then 'LARGE' else category end as category) from v_products""",
    "y_orders": """
select * replace (case when order_id % 107 = 11 then ordered_at + interval 40 day else ordered_at end as ordered_at) from n_orders""",
    "y_payments": """
select * replace (case when payment_id % 223 = 6 then cast(amount * cast(0.5 as decimal(2,1)) as decimal(12,2)) else amount end as amount)
from v_payments where payment_id % 211 <> 5""",
    "y_kept": """
select * from y_orders where total_amount = unit_price * quantity
qualify row_number() over (partition by customer_id, product_id, ordered_at order by order_id) = 1""",
}

VIEWS["v_incidents"] = f"""
select event_id as incident_id, ([{_texts(defects.REGISTRY)}])[1 + event_id % {len(defects.REGISTRY)}] as failure_key,
  concat('event ', cast(event_id as varchar)) as detail, ts as injected_at from events"""


def _with(body: str) -> str:
    """``body`` behind the views it needs, direct or not."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for view, definition in VIEWS.items():
            if view in text and view not in needed:
                needed.add(view)
                need(definition)

    need(body)
    views = ", ".join(f"{view} as ({VIEWS[view]})" for view in VIEWS if view in needed)
    body = body.strip()
    if not views:
        return body
    return f"with {views}, {body[5:]}" if body.startswith("with ") else f"with {views} {body}"


def _day(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d')"


def _moment(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"


def _cents(amount: str, rows: str) -> str:
    """Average in cents, halves rounded away from zero, in whole numbers."""
    cents = f"sign({amount}) * ((2 * abs(cast({amount} * 100 as hugeint)) + {rows}) // (2 * {rows}))"
    return f"cast(cast({cents} as decimal(20,0)) * cast(0.01 as decimal(3,2)) as double)"


NET = "case when status in ('returned', 'cancelled') then 0 else total_amount end"
REVENUE = (
    f"count(*) as orders, cast(sum(total_amount) as double) as gross_revenue, cast(sum({NET}) as double) as net_revenue"
)
ORDER_COLUMNS = f"""order_id, customer_id, product_id, quantity, cast(unit_price as double) as unit_price,
  cast(total_amount as double) as total_amount, status, {_moment('ordered_at')} as ordered_at"""
CUSTOMER_COLUMNS = f"customer_id, full_name, email, country, city, segment, {_moment('created_at')} as created_at"
PRODUCT_COLUMNS = f"""product_id, sku, name, category, cast(unit_price as double) as unit_price,
  cast(cost as double) as cost, {_moment('created_at')} as created_at"""
PAYMENT_COLUMNS = f"""payment_id, order_id, method, cast(amount as double) as amount, status,
  {_moment('paid_at')} as paid_at"""
EVERY_DAY = """day_line as (
  select cast(unnest(generate_series(min(ordered_at), max(ordered_at), interval 1 day)) as date) as day from v_orders),
daily as (
  select l.day, count(order_id) as orders, coalesce(sum(total_amount), 0) as revenue
  from day_line l left join v_orders on cast(ordered_at as date) = l.day group by l.day)"""
COVERED = """paid as (select order_id as paid_order, sum(amount) as paid from d_payments group by order_id),
covered as (select o.*, coalesce(paid, 0) as paid, case when paid is null then 'missing' when paid < total_amount
  then 'under' when paid > total_amount then 'over' else 'ok' end as coverage
  from d_orders o left join paid on paid_order = order_id)"""
FACTS = f"""{COVERED},
facts as (select c.*, segment, country, category, cost * quantity as cost_amount,
  status is null or status not in ('returned', 'cancelled') as earns_revenue
  from covered c left join v_customers u on u.customer_id = c.customer_id
  left join v_products p on p.product_id = c.product_id)"""
FACT_COLUMNS = f"""select order_id, {_day('ordered_at')} as order_day, {_moment('ordered_at')} as ordered_at,
  customer_id, segment, country, product_id, category, quantity, cast(unit_price as double) as unit_price,
  cast(total_amount as double) as total_amount, cast(cost_amount as double) as cost_amount,
  cast(total_amount - cost_amount as double) as margin_amount, status, earns_revenue,
  cast(paid as double) as paid, coverage from facts"""
SYNCED_FACTS = FACTS.replace("d_orders", "y_kept").replace("d_payments", "y_payments").replace("v_customers", "y_customers").replace("v_products", "y_products")
KEPT = """kept as (select * from d_orders qualify row_number() over (
  partition by customer_id, product_id, ordered_at order by order_id) = 1)"""


def _cut(cut: str, column: str) -> str:
    return f"select '{cut}' as cut, {column} as label, {REVENUE} from facts group by {column}"


def _gate(check: str, table: str, key: str, broken: str, severity: str = "error") -> str:
    return f"""select '{check}' as "check", '{severity}' as severity, count(*) as failed_rows,
  cast(min({key}) as varchar) as sample from {table} where {broken}"""


VIEW_OF = {"customers": "v_customers", "products": "v_products", "orders": "d_orders", "payments": "d_payments"}
KEY_OF = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "payments": "payment_id"}


def _gates(rules: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        _gate(f"{table}: {name}", VIEW_OF[table], KEY_OF[table], broken) for table, name, broken in rules
    )


def _unique_gate(table: str, columns: str) -> str:
    return f"""select '{table}: {columns} unique' as "check", 'error' as severity,
  cast(coalesce(sum(n - 1), 0) as bigint) as failed_rows, cast(min(k) as varchar) as sample
  from (select count(*) as n, min({KEY_OF[table]}) as k from {VIEW_OF[table]} group by {columns} having count(*) > 1)"""


def _reference_gate(table: str, column: str, dim: str) -> str:
    return f"""select '{table}: {column} known' as "check", 'error' as severity, count(*) as failed_rows,
  cast(min({KEY_OF[table]}) as varchar) as sample from {VIEW_OF[table]} f
  where not exists (select 1 from {VIEW_OF[dim]} d where d.{column} = f.{column})"""


def _draw(tag: str, row_id: str, seed: int = SEED) -> str:
    """The same whole number as ``scalars.draw``."""
    multiplier, offset = draw_constants(seed, tag)
    p = DRAW_MODULUS
    mixed = f"((({row_id}) % {p}) * {multiplier} + (({row_id}) // {p}) * 69621 + {offset}) % {p}"
    return f"(((({mixed}) * ({mixed})) % {p} * 16807 + ({mixed})) % {p})"


def _pick(words, tag: str, row_id: str) -> str:
    words = list(words)
    return f"([{_texts(words)}])[1 + {_draw(tag, row_id)} % {len(words)}]"


def _between(low: str, high: str, tag: str, row_id: str) -> str:
    first, last = f"(epoch_us({low}) // 1000000)", f"(epoch_us({high}) // 1000000)"
    span = f"(greatest({last} - {first}, 0) + 1)"
    return f"make_timestamp(({first} + {_draw(tag, row_id)} % {span}) * 1000000)"


HISTORY = (f"({AS_OF} - interval 1095 day)", f"({AS_OF} - interval 1 day)")
CENT = "cast(0.01 as decimal(3,2))"


def _letter(number: str, place: int) -> str:
    return f"substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast(({number}) // {26**place} % 26 + 1 as int), 1)"


VIEWS["s_customers"] = f"""
select c_custkey as customer_id, full_name,
  concat(replace(replace(lower(full_name), ' ', '.'), '''', ''), '.', cast(c_custkey + 1000 as varchar), '@',
    {_pick(synth.MAIL_HOSTS, 'mail host', 'c_custkey')}) as email,
  {_pick(synth.COUNTRIES, 'country', 'c_custkey')} as country, {_pick(synth.CITIES, 'city', 'c_custkey')} as city,
  {_pick(SEGMENTS, 'segment', 'c_custkey')} as segment,
  {_between(*HISTORY, 'signup', 'c_custkey')} as created_at
from (select c_custkey, concat({_pick(synth.FIRST_NAMES, 'first name', 'c_custkey')}, ' ',
  {_pick(synth.LAST_NAMES, 'last name', 'c_custkey')}) as full_name from customer)"""

_low = ", ".join(str(low * 100) for low, _ in CATEGORY_PRICE_BOUNDS.values())
_high = ", ".join(str(high * 100) for _, high in CATEGORY_PRICE_BOUNDS.values())
_place = f"1 + {_draw('category', 'p_partkey')} % {len(CATEGORY_PRICE_BOUNDS)}"
_word = _pick(synth.WORDS, "word", "k")
VIEWS["s_products"] = f"""
select k as product_id,
  concat({_letter('k // 100000000', 2)}, {_letter('k // 100000000', 1)}, {_letter('k // 100000000', 0)}, '-',
    lpad(cast(k % 100000000 as varchar), 8, '0')) as sku,
  concat({_pick(synth.COLORS, 'color', 'k')}, ' ', upper(substring({_word}, 1, 1)), substring({_word}, 2), ' ',
    case when ends_with(category, 's') then substring(category, 1, length(category) - 1) else category end) as name,
  category, unit_price,
  cast(unit_price * cast(45 + {_draw('cost', 'k')} % 36 as decimal(4,0)) * {CENT} as decimal(10,2)) as cost,
  {_between(*HISTORY, 'listed', 'k')} as created_at
from (select k, ([{_texts(CATEGORY_PRICE_BOUNDS)}])[place] as category,
    cast(cast(lo + {_draw('price', 'k')} % (hi - lo + 1) as decimal(10,0)) * {CENT} as decimal(10,2)) as unit_price
  from (select k, place, cast(([{_low}])[place] as bigint) as lo, cast(([{_high}])[place] as bigint) as hi
    from (select p_partkey as k, {_place} as place from part)))"""
VIEWS["s_orders"] = f"""
select order_id, customer_id, product_id, quantity, unit_price,
  cast(unit_price * quantity as decimal(12,2)) as total_amount, d.status,
  {_between('created_at', AS_OF, 'ordered', 'order_id')} as ordered_at
from (select o_orderkey as order_id,
    {_draw('buyer', 'o_orderkey')} % (select count(*) from customer) as buyer,
    {_draw('item', 'o_orderkey')} % (select count(*) from part) as item,
    cast({_draw('quantity', 'o_orderkey')} % 6 + 1 as int) as quantity,
    {_pick(ORDER_STATUSES, 'status', 'o_orderkey')} as status from orders) d
join s_customers c on c.customer_id = buyer
join (select product_id, unit_price from s_products) p on p.product_id = item"""
VIEWS["s_payments"] = f"""
select order_id as payment_id, order_id, {_pick(PAYMENT_METHODS, 'method', 'order_id')} as method,
  total_amount as amount,
  case when status = 'returned' then 'refunded'
    else {_pick(PAYMENT_STATUSES, 'payment status', 'order_id')} end as status,
  {_between('ordered_at', AS_OF, 'paid', 'order_id')} as paid_at
from s_orders"""


def _sample(table: str, key: str, n: int, tag: str) -> str:
    """Sampled rows with their slot."""
    order = f"{_draw(tag, key)}, {key}"
    return f"(select *, row_number() over (order by {order}) - 1 as slot from {table} order by {order} limit {n})"


def _one_order(tag: str, quantity="1", unit_price=None, total=None, status="placed", customer=True, at=AS_OF) -> str:
    buyer = f"(select customer_id from {_sample('v_customers', 'customer_id', 1, tag)})" if customer else "null"
    paid = unit_price or "unit_price"
    return f"""select (select max(order_id) + 1 from v_orders) as order_id, {buyer} as customer_id, product_id,
  {quantity} as quantity, cast({paid} as decimal(10,2)) as unit_price,
  cast({total or paid} as decimal(12,2)) as total_amount, '{status}' as status, {at} as ordered_at
  from {_sample('v_products', 'product_id', 1, tag)}"""


def _after(row: str) -> str:
    return f"select {ORDER_COLUMNS} from (select * from v_orders union all {row})"


def _burst(start: str) -> str:
    people, goods = (
        _sample("v_customers", "customer_id", 50, "volume_spike"),
        _sample("v_products", "product_id", 50, "volume_spike"),
    )
    return f"""select {start} + i as order_id, c.customer_id, p.product_id, 1 as quantity, p.unit_price,
  cast(p.unit_price as decimal(12,2)) as total_amount, 'placed' as status, {AS_OF} as ordered_at
  from (select unnest(range({defects.BURST})) as i)
  join {people} c on c.slot = i % least(50, (select count(*) from v_customers))
  join {goods} p on p.slot = i % least(50, (select count(*) from v_products))"""


def _update(changed: str, chosen: str) -> str:
    """Orders with some columns replaced on the chosen ids."""
    columns = {name: name for name in ORDERS.fieldNames()} | dict([changed.split("=", 1)])
    listed = ", ".join(
        name if value == name else f"case when order_id in ({chosen}) then {value} else {name} end as {name}"
        for name, value in columns.items()
    )
    return f"select {listed} from v_orders"


NEXT_ORDER = "(select max(order_id) + 1 from v_orders)"
LATEST = "select order_id from v_orders order by order_id desc limit {n}"
NOT_CANCELLED = "select order_id from v_orders where status <> 'cancelled' order by order_id desc limit 200"
CUT_PRODUCTS = f"select product_id from {_sample('v_products', 'product_id', 20, 'price_cut')}"
HALVED = f"""select product_id, sku, name, category, case when product_id in ({CUT_PRODUCTS})
  then cast(round(unit_price * cast(0.5 as decimal(2,1)), 2) as decimal(10,2)) else unit_price end as unit_price,
  cost, created_at from v_products"""
CANCELLED = _update("status='cancelled'", NOT_CANCELLED)

NULL_RULES = [
    (table, f"{name} is null", f"{name} is null") for table, schema in TABLES.items() for name in schema.fieldNames()
]
ACCEPTED = [
    (table, f"{column} not accepted", f"{column} not in ({_texts(words)})")
    for table, columns in star.star_domains().items()
    for column, words in columns.items()
]
NEGATIVE = [
    ("products", "unit_price negative", "unit_price < 0"),
    ("products", "cost negative", "cost < 0"),
    ("orders", "unit_price negative", "unit_price < 0"),
    ("orders", "total_amount negative", "total_amount < 0"),
    ("payments", "amount negative", "amount < 0"),
]
ARITHMETIC = "total_amount <> unit_price * quantity"
STATUS_LIST = _texts(ORDER_STATUSES)
REASONS = {
    "quantity uncastable": "order_id % 937 = 10",
    "customer_id is null": "customer_id is null",
    "quantity is null": "order_id % 937 = 10",
    "status not accepted": f"status not in ({STATUS_LIST})",
    "unit_price negative": "unit_price < 0",
    "total_amount negative": "total_amount < 0",
    "quantity not positive": "order_id % 937 <> 10 and quantity <= 0",
    "total is not price times quantity": f"order_id % 937 <> 10 and {ARITHMETIC}",
}
BAD_ROW = f"""(customer_id is null or status not in ({STATUS_LIST}) or unit_price < 0 or total_amount < 0
  or quantity <= 0 or {ARITHMETIC})"""
TOTALS = "cast(ordered_at as date) as day, count(*) as n, sum(total_amount) as amount"
CHANGES = """changes as (
  select coalesce(o.order_id, n.order_id) as order_id,
    case when o.order_id is null then 'insert' when n.order_id is null then 'delete' else 'update' end as change,
    o.status as old_status, n.status as new_status, cast(o.total_amount as double) as old_total,
    cast(n.total_amount as double) as new_total
  from v_orders o full outer join n_orders n on o.order_id = n.order_id
  where o.order_id is null or n.order_id is null or o.status <> n.status or o.total_amount <> n.total_amount)"""
CONTRACT = " union all ".join(
    f"""select 'orders' as table_name, '{field.name}' as column_name, '{field.dataType.simpleString()}' as expected_type,
  {'null' if field.name == 'customer_id' else "'" + field.dataType.simpleString() + "'"} as actual_type,
  '{'missing' if field.name == 'customer_id' else 'ok'}' as state,
  {'nullif(count(*), count(*))' if field.name == 'customer_id' else f'count(*) filter (where {field.name} is null)'} as null_rows
  from d_orders"""
    for field in ORDERS.fields
)
LEDGER = " union all ".join(
    f"select '{key}' as failure_key, order_id + {100000000 if key == 'duplicate_order' else 0} as item "
    f"from v_orders where order_id % {modulus} = {residue}"
    for key, (modulus, residue) in star.FAILURE_KEYS_IN_VIEWS.items()
    if key != "orphan_payment"
)
DETECTED = f"""
select 'missing_customer' as failure_key, order_id as item from d_orders where customer_id is null
union all select 'invalid_quantity', order_id from d_orders where quantity <= 0
union all select 'negative_price', order_id from d_orders where unit_price < 0 or total_amount < 0
union all select 'destructive_fix', order_id from d_orders
  where {ARITHMETIC} and not quantity <= 0 and not (unit_price < 0 or total_amount < 0)
union all select 'malformed_data', order_id from d_orders where status not in ({STATUS_LIST})
union all select 'duplicate_order', order_id from d_orders where order_id not in (select order_id from kept)
union all select 'orphan_payment', payment_id from d_payments where order_id not in (select order_id from d_orders)"""



def _decomposition() -> str:
    """Shapley parts of the change of net revenue, month by month."""
    states = [(s, p, k) for s in (0, 1) for p in (0, 1) for k in (0, 1)]
    sums = ", ".join(f"sum(s_{s} * p_{p} * k_{k}) as r_{s}{p}{k}" for s, p, k in states)

    def part(place: int) -> str:
        units = ("q_old", "q_new")
        terms = [
            f"{weight!r} * {units[state[0]]} * r_{''.join(map(str, state[1:]))}"
            for state, weight in decompose.shapley_weights(place).items()
        ]
        return f"cast(round(cast({' + '.join(terms)} as decimal(28,8)), 2) as decimal(28,2))"

    volume, price, cancellation = part(0), part(2), part(3)
    return f"""with cells as (select date_trunc('month', ordered_at) as month, category, cast(sum(quantity) as double) as q,
        sum(total_amount) as g, sum({NET}) as n, count(*) as o, count(*) filter (where status = 'cancelled') as c
        from v_orders join v_products using (product_id) group by all),
      span as (select min(month) as low, max(month) as high from cells),
      sides as (select month, category, q as q1, g as g1, n as n1, o as o1, c as c1, 0 as q0, 0 as g0, 0 as n0, 0 as o0, 0 as c0 from cells
        union all select month + interval 1 month, category, 0, 0, 0, 0, 0, q, g, n, o, c from cells),
      paired as (select month, category, sum(q0) as q0, sum(g0) as g0, sum(n0) as n0, sum(o0) as o0, sum(c0) as c0, sum(q1) as q1,
        sum(g1) as g1, sum(n1) as n1, sum(o1) as o1, sum(c1) as c1 from sides group by all),
      shares as (select *, sum(q0) over w as q_old, sum(q1) over w as q_new, sum(n0) over w as n_old, sum(n1) over w as n_new,
        sum(o0) over w as o_old, sum(o1) over w as o_new, sum(c0) over w as c_old, sum(c1) over w as c_new
        from paired, span where month > low and month <= high window w as (partition by month)),
      factors as (select *, coalesce(s0, s1, 0) as s_0, coalesce(s1, s0, 0) as s_1, coalesce(p0, p1, 0) as p_0, coalesce(p1, p0, 0) as p_1,
        coalesce(k0, k1, 0) as k_0, coalesce(k1, k0, 0) as k_1 from (select *, q0 / nullif(q_old, 0) as s0, q1 / nullif(q_new, 0) as s1,
          cast(g0 as double) / nullif(q0, 0) as p0, cast(g1 as double) / nullif(q1, 0) as p1,
          cast(n0 as double) / nullif(cast(g0 as double), 0) as k0, cast(n1 as double) / nullif(cast(g1 as double), 0) as k1 from shares)),
      summed as (select month, q_old, q_new, n_old, n_new, o_old, o_new, c_old, c_new, {sums} from factors group by all),
      parts as (select *, {volume} as volume, {price} as price, {cancellation} as cancellation from summed)
      select {_day('month')} as month, cast(n_old as double) as net_old, cast(n_new as double) as net_new,
        cast(n_new - n_old as double) as change, cast(volume as double) as volume,
        cast(n_new - n_old - volume - price - cancellation as double) as mix, cast(price as double) as price,
        cast(cancellation as double) as cancellation, round(c_old / nullif(o_old, 0), 4) as cancellation_rate_old,
        round(c_new / nullif(o_new, 0), 4) as cancellation_rate_new from parts"""


SQL = {
    "revenue_decomposition": _decomposition(),
    "daily_revenue": f"select {_day('ordered_at')} as day, {REVENUE} from v_orders group by 1",
    "revenue_by_category": f"""select category, {REVENUE} from v_orders o
        join v_products p on p.product_id = o.product_id group by category""",
    "revenue_by_segment": f"""select segment, {REVENUE} from v_orders o
        join v_customers c on c.customer_id = o.customer_id group by segment""",
    "revenue_by_country": f"""select country, {REVENUE} from v_orders o
        join v_customers c on c.customer_id = o.customer_id group by country""",
    "revenue_grouping_sets": f"with {FACTS} "
    + " union all ".join(
        [_cut("day", _day("ordered_at"))] + [_cut(name, name) for name in ("category", "segment", "country")]
    ),
    "aov_orders_per_day": f"""select {_day('ordered_at')} as day, count(*) as orders,
        {_cents('sum(total_amount)', 'count(*)')} as aov from v_orders group by 1""",
    "rolling_aov_7d": f"""with {EVERY_DAY}, rolled as (
        select day, count(*) over w as window_days, cast(sum(orders) over w as bigint) as window_orders,
          sum(revenue) over w as revenue from daily window w as (order by day rows between 6 preceding and current row))
        select {_day('day')} as day, window_days, window_orders, cast(revenue as double) as window_revenue,
          case when window_orders > 0 then {_cents('revenue', 'window_orders')} end as rolling_aov,
          round(window_orders / window_days, 4) as orders_per_day from rolled""",
    "customer_ltv": f"""select customer_id, count(*) as orders, cast(sum({NET}) as double) as ltv,
        cast(sum(total_amount) as double) as gross_value, {_moment('min(ordered_at)')} as first_at,
        {_moment('max(ordered_at)')} as last_at from d_orders where customer_id is not null group by customer_id""",
    "top_customers_ltv": f"""with ranked as (select customer_id, count(*) as orders, sum({NET}) as value,
        sum(total_amount) as gross, min(ordered_at) as first_at, max(ordered_at) as last_at
        from v_orders group by customer_id order by value desc, customer_id limit 100)
        select customer_id, orders, cast(value as double) as ltv, cast(gross as double) as gross_value,
          {_moment('first_at')} as first_at, {_moment('last_at')} as last_at from ranked""",
    "payment_coverage": f"""with {COVERED} select order_id, cast(total_amount as double) as total_amount,
        cast(paid as double) as paid, cast(total_amount - paid as double) as gap, coverage
        from covered where coverage <> 'ok'""",
    "orphan_orders": f"""select {ORDER_COLUMNS} from d_orders o
        where not exists (select 1 from v_customers c where c.customer_id = o.customer_id)""",
    "orphan_products": f"""select {ORDER_COLUMNS} from v_orders o where not exists (
        select 1 from v_products p where p.product_id = o.product_id and category <> 'LARGE')""",
    "orphan_payments": f"""select {PAYMENT_COLUMNS} from d_payments p
        where not exists (select 1 from d_orders o where o.order_id = p.order_id)""",
    "orphan_summary": """
        select 'orders without customer' as kind, count(*) as rows, cast(coalesce(sum(total_amount), 0) as double) as amount
        from d_orders o where not exists (select 1 from v_customers c where c.customer_id = o.customer_id)
        union all select 'orders without product', count(*), cast(coalesce(sum(total_amount), 0) as double)
        from d_orders o where not exists (select 1 from v_products p where p.product_id = o.product_id)
        union all select 'payments without order', count(*), cast(coalesce(sum(amount), 0) as double)
        from d_payments p where not exists (select 1 from d_orders o where o.order_id = p.order_id)""",
    "dod_change": f"""with {EVERY_DAY} select {_day('day')} as day, orders, lag(orders) over (order by day) as previous_orders,
        round(orders / nullif(lag(orders) over (order by day), 0), 4) as ratio from daily""",
    "volume_anomaly": f"""with {EVERY_DAY}, based as (select day, orders, count(*) over w as n,
          coalesce(sum(orders) over w, 0) as s, avg(orders) over w as mean, stddev_samp(orders) over w as sd
          from daily window w as (order by day rows between 28 preceding and 1 preceding))
        select {_day('day')} as day, orders, n as baseline_days, cast(s as bigint) as baseline_orders,
          case when orders > mean + 3 * sd then 'spike' when orders < mean - 3 * sd then 'drop' else 'normal' end as flag
        from based""",
    "product_margin": """select o.product_id, any_value(category) as category, cast(sum(quantity) as bigint) as units,
        cast(sum(total_amount) as double) as revenue, cast(sum(total_amount - cost * quantity) as double) as margin
        from v_orders o join v_products p on p.product_id = o.product_id group by o.product_id""",
    "late_signups": f"""select order_id, o.customer_id, {_moment('ordered_at')} as ordered_at,
        {_moment('signup')} as created_at from v_orders o
        join (select customer_id, created_at + cast(customer_id as int) * interval 1 day as signup from v_customers) c
        on c.customer_id = o.customer_id where ordered_at < signup""",
    "malformed_statuses": f"""select order_id, status, true as noise from d_orders
        where status not in ({STATUS_LIST})""",
    "timing_percentiles": """select event_type as question, p as probability, count(value) as rows,
        round(case when p = 0.95 then quantile_cont(value, 0.95) else quantile_cont(value, 0.99) end, 4) as quantile
        from events, (values (cast(0.95 as double)), (cast(0.99 as double))) t(p) group by event_type, p""",
    "stg_orders": f"select {ORDER_COLUMNS} from d_orders where not coalesce({BAD_ROW}, true) and order_id % 937 <> 10",
    "quarantined_orders": f"""select order_id, customer_id, product_id,
        case when order_id % 937 <> 10 then quantity end as quantity, cast(unit_price as double) as unit_price,
        cast(total_amount as double) as total_amount, status, {_moment('ordered_at')} as ordered_at,
        concat_ws('; ', {", ".join(f"case when {broken} then '{name}' end" for name, broken in REASONS.items())}) as reasons
        from d_orders where coalesce({BAD_ROW}, true) or order_id % 937 = 10""",
    "dedup_orders": f"with {KEPT} select {ORDER_COLUMNS} from kept",
    "dedup_removed": f"""select {ORDER_COLUMNS} from (select * from d_orders qualify row_number() over (
        partition by customer_id, product_id, ordered_at order by order_id) > 1)""",
    "rename_back": "select order_id, customer_id from v_orders",
    "dim_customers": f"""select customer_id, full_name, email, country, city, segment,
        {_day('created_at')} as signup_day from v_customers""",
    "dim_products": f"""select product_id, sku, name, category, cast(unit_price as double) as unit_price,
        cast(cost as double) as cost, cast(unit_price - cost as double) as unit_margin,
        {_day('created_at')} as listed_day from v_products""",
    "fct_orders": f"with {FACTS} {FACT_COLUMNS}",
    "fct_daily_revenue": f"""with {KEPT} select {_day('ordered_at')} as day, {REVENUE},
        {_cents('sum(total_amount)', 'count(*)')} as aov from kept group by 1""",
    "gate_not_null": _gates(NULL_RULES),
    "gate_accepted_values": _gates(ACCEPTED),
    "gate_non_negative": _gates(NEGATIVE),
    "gate_positive_qty": _gates([("orders", "quantity not positive", "quantity <= 0")]),
    "gate_row_arithmetic": _gates([("orders", "total is not price times quantity", ARITHMETIC)]),
    "gate_payment_rules": " union all ".join(
        _gate(
            f"payments: {name}",
            "(select p.*, o.status as order_status, o.ordered_at from d_payments p "
            "left join d_orders o on o.order_id = p.order_id)",
            "payment_id",
            broken,
        )
        for name, broken in (
            ("returned order is not refunded", "order_status = 'returned' and status <> 'refunded'"),
            ("paid before ordered", "paid_at < ordered_at"),
        )
    ),
    "gate_unique": " union all ".join(
        [_unique_gate(table, KEY_OF[table]) for table in TABLES]
        + [_unique_gate("customers", "email"), _unique_gate("products", "sku")]
        + [_unique_gate("orders", "customer_id, product_id, ordered_at")]
    ),
    "gate_relationships": " union all ".join(
        [
            _reference_gate("orders", "customer_id", "customers"),
            _reference_gate("orders", "product_id", "products"),
            _reference_gate("payments", "order_id", "orders"),
        ]
    ),
    "gate_contract": CONTRACT
    + """ union all select 'orders', 'user_id', null, 'bigint', 'extra', count(*) filter (where customer_id is null)
        from d_orders""",
    "gate_freshness": " union all ".join(
        f"""select '{table}' as table_name, {_moment(f'max({moment})')} as newest_at,
        epoch_us({AS_OF}) // 1000000 - epoch_us(max({moment})) // 1000000 as lag_seconds,
        epoch_us({AS_OF}) // 1000000 - epoch_us(max({moment})) // 1000000 <= 86400 as fresh from {VIEW_OF[table]}"""
        for table, moment in (
            ("customers", "created_at"),
            ("products", "created_at"),
            ("orders", "ordered_at"),
            ("payments", "paid_at"),
        )
    ),
    "gate_volume": f"""with {EVERY_DAY.replace('v_orders', 'd_orders')}, based as (select day, orders,
          avg(orders) over w as mean, stddev_samp(orders) over w as sd
          from daily window w as (order by day rows between 28 preceding and 1 preceding))
        select 'orders: daily volume' as "check", 'warn' as severity, count(*) as failed_rows,
          {_day('min(day)')} as sample from based where orders > mean + 3 * sd or orders < mean - 3 * sd""",
    "open_day_volume": f"""with noon as (select date_trunc('day', max(ts)) + interval 12 hour as t from events),
        counted as (select cast(ts as date) as day, count(*) as n from events, noon
          where ts <= t and epoch_us(ts) // 1000000 % 86400 <= 43200 group by 1),
        line as (select cast(unnest(generate_series((select min(day) from counted), (select cast(t as date) from noon), interval 1 day)) as date) as day),
        daily as (select line.day, cast(coalesce(n, 0) as hugeint) as x from line left join counted using (day)),
        w as (select day, x, count(*) over b as n, coalesce(sum(x) over b, 0) as s, coalesce(sum(x * x) over b, 0) as q from daily
          window b as (order by day rows between 28 preceding and 1 preceding))
        select {_day('day')} as day, cast(x as bigint) as orders, n as baseline_days, cast(s as bigint) as baseline_orders,
          case when (n * x - s) * (n * x - s) * (n - 1) > 9 * n * (n * q - s * s) and n * x > s then 'spike'
            when (n * x - s) * (n * x - s) * (n - 1) > 9 * n * (n * q - s * s) and n * x < s then 'drop' else 'normal' end as flag
        from w where day = (select cast(t as date) from noon)""",
    "late_rows": f"""select {ORDER_COLUMNS}, {_moment('landed_at')} as landed_at,
        cast(date_diff('day', cast(ordered_at as date), cast(landed_at as date)) as int) as days_late
        from l_orders where cast(landed_at as date) > cast(ordered_at as date)""",
    "reconcile_closed_days": f"""with judged as (select *, coalesce({BAD_ROW}, true) as bad from d_orders),
        numbered as (select *, row_number() over (partition by bad, customer_id, product_id, ordered_at
          order by order_id) as nth from judged)
        select {_day('ordered_at')} as day, count(*) as source_rows, cast(sum(total_amount) as double) as source_amount,
          count(*) filter (where not bad and nth = 1) as kept_rows,
          cast(coalesce(sum(total_amount) filter (where not bad and nth = 1), 0) as double) as kept_amount,
          count(*) filter (where not bad and nth > 1) as removed_rows,
          cast(coalesce(sum(total_amount) filter (where not bad and nth > 1), 0) as double) as removed_amount,
          count(*) filter (where bad) as aside_rows,
          cast(coalesce(sum(total_amount) filter (where bad), 0) as double) as aside_amount, true as agrees
        from numbered where cast(ordered_at as date) < (select max(cast(ordered_at as date)) + 1 from d_orders) group by 1""",
    "reconcile_history": f"""with s as (select {TOTALS} from v_orders where order_id % 4 = 0 group by 1),
        c as (select {TOTALS} from l_orders group by 1),
        l as (select {TOTALS} from l_orders where order_id % 4 <> 0 group by 1),
        filled as (select coalesce(s.day, c.day, l.day) as day, coalesce(s.n, 0) as sn, coalesce(s.amount, 0) as sa,
          coalesce(c.n, 0) as cn, coalesce(c.amount, 0) as ca, coalesce(l.n, 0) as ln, coalesce(l.amount, 0) as la
          from s full outer join c on s.day = c.day full outer join l on l.day = coalesce(s.day, c.day))
        select {_day('day')} as day, sn as stored_rows, cast(sa as double) as stored_amount, cn as current_rows,
          cast(ca as double) as current_amount, ln as late_rows, cast(la as double) as late_amount,
          case when sn = cn and sa = ca then 'ok' when sn + ln = cn and sa + la = ca then 'late' else 'mismatch' end as state
        from filled where day is null or day < (select max(cast(ordered_at as date)) + 1 from l_orders)""",
    "control_totals": f"""select {_day('ordered_at')} as day, count(*) as rows, cast(sum(total_amount) as double) as amount
        from d_orders group by 1""",
    "revenue_drivers": f"""select 'cancellations' as driver, count(*) as rows,
          cast(-sum({NET}) as double) as amount from v_orders where order_id in ({NOT_CANCELLED})
        union all select 'price changes', count(*), cast(sum(h.unit_price - p.unit_price) as double)
          from v_products p join ({HALVED}) h on h.product_id = p.product_id where h.unit_price <> p.unit_price""",
    "detection_score": f"""with {KEPT}, ledger as ({LEDGER} union all
          select 'orphan_payment', payment_id from v_payments where order_id % 953 = 7 and order_id % 941 <> 9),
        detected as ({DETECTED}),
        items as (select failure_key, item, max(i) as i, max(d) as d from (
          select failure_key, item, 1 as i, 0 as d from ledger union all select failure_key, item, 0, 1 from detected)
          group by failure_key, item)
        select failure_key, cast(sum(i) as bigint) as injected, cast(sum(d) as bigint) as detected,
          cast(sum(i * d) as bigint) as hits, round(sum(i * d) / nullif(sum(d), 0), 4) as "precision",
          round(sum(i * d) / nullif(sum(i), 0), 4) as recall from items group by failure_key""",
    "detection_by_build": f"""with {KEPT}, ledger as ({LEDGER} union all
          select 'orphan_payment', payment_id from v_payments where order_id % 953 = 7 and order_id % 941 <> 9),
        struck as (select failure_key, date_trunc('month', ordered_at) as m, count(*) as n,
          sum(epoch_us(date_trunc('month', ordered_at) + interval 1 month) // 1000000 - 1 - epoch_us(ordered_at) // 1000000) as delay
          from ledger join v_orders on order_id = item % 100000000 group by all),
        judged as (select *, date_trunc('month', ordered_at) as m from d_orders),
        accused as (select 'missing_customer' as failure_key, m from judged where customer_id is null
          union select 'invalid_quantity', m from judged where quantity <= 0
          union select k, m from judged, (values ('negative_price'), ('recurring_incident')) t(k) where unit_price < 0 or total_amount < 0
          union select 'destructive_fix', m from judged where {ARITHMETIC}
          union select 'malformed_data', m from judged where status not in ({STATUS_LIST})
          union select 'duplicate_order', m from judged where order_id not in (select order_id from kept)
          union select 'orphan_payment', date_trunc('month', paid_at) from d_payments where order_id not in (select order_id from d_orders)),
        cells as (select failure_key, m, coalesce(n, 0) as n, delay, s.m is not null as had, a.m is not null as blamed
          from struck s full outer join accused a using (failure_key, m))
        select failure_key, cast(sum(n) as bigint) as incidents, cast(0 as bigint) as unseen,
          count(*) filter (where had) as builds_struck, count(*) filter (where blamed) as builds_accused,
          count(*) filter (where had and blamed) as hits,
          round(count(*) filter (where had and blamed) / nullif(count(*) filter (where blamed), 0), 4) as "precision",
          round(count(*) filter (where had and blamed) / nullif(count(*) filter (where had), 0), 4) as recall,
          round(sum(delay) / nullif(sum(n), 0), 1) as mean_delay_seconds
        from cells group by failure_key""",
    "snapshot_diff": f"with {CHANGES} select * from changes",
    "snapshot_diff_by_fingerprint": f"with {CHANGES} select * from changes",
    "snapshot_diff_by_tree": f"with {CHANGES} select * from changes",
    "snapshot_brought_up": f"select {ORDER_COLUMNS} from n_orders",
    "apply_changes": f"select {ORDER_COLUMNS} from n_orders",
    "latest_version": """select user_id, event_id, event_type, value from events
        qualify row_number() over (partition by user_id order by event_id desc) = 1""",
    "new_rows": f"select {ORDER_COLUMNS} from n_orders where order_id > 0 and order_id not in (select order_id from v_orders)",
    "append_keys": """select (select max(p_partkey) from part) + row_number() over (order by c_acctbal, c_custkey) as item_id,
        c_name as n from customer""",
    "row_difference": f"""with counted as (select {ORDER_COLUMNS}, sum(w) as balance from (
          select *, 1 as w from v_orders union all select *, -1 from n_orders) group by all)
        select * exclude (balance), case when balance > 0 then 'left' else 'right' end as side,
          cast(abs(balance) as bigint) as copies from counted where balance <> 0""",
    "table_counts": " union all ".join(
        f"select '{table}' as table_name, count(*) as rows from {view}" for table, view in VIEW_OF.items()
    ),
    "full_refresh": " union all ".join(
        f"select '{table}' as table_name, count(*) as rows from v_{table}" for table in TABLES
    ),
    "ledger_append": """select failure_key, count(*) as incidents, count(distinct incident_id) as ids,
        (select count(*) from v_incidents) as highest_id from v_incidents group by failure_key""",
    "incident_counts": "select failure_key, count(*) as incidents from v_incidents group by failure_key",
    "incident_occurrence": f"""select incident_id, failure_key, detail, {_moment('injected_at')} as injected_at,
        row_number() over (partition by failure_key order by injected_at, incident_id) as occurrence from v_incidents""",
    "incidents_of_key": f"""select incident_id, failure_key, detail, {_moment('injected_at')} as injected_at
        from v_incidents where failure_key = 'recurring_incident'""",
    "sample_customers": f"""select {CUSTOMER_COLUMNS}, cast(slot as int) as slot
        from {_sample('v_customers', 'customer_id', 200, 'sample')}""",
    "latest_order": f"select {ORDER_COLUMNS} from (select * from v_orders order by order_id desc limit 1)",
    "recent_n_update": f"select {ORDER_COLUMNS} from ({_update('total_amount=0', LATEST.format(n=300))})",
    "bulk_price_cut": f"select {PRODUCT_COLUMNS} from ({HALVED})",
    "volume_spike_rows": f"select {ORDER_COLUMNS} from ({_burst(NEXT_ORDER)})",
    "defect_negative_price": _after(_one_order("negative_price", unit_price="-49.99")),
    "defect_missing_customer": _after(_one_order("missing_customer", customer=False)),
    "defect_invalid_quantity": _after(_one_order("invalid_quantity", quantity="-5", total="0")),
    "defect_duplicate_order": _after(
        "select order_id + 1, customer_id, product_id, quantity, unit_price, total_amount, status, ordered_at "
        "from v_orders where order_id = (select max(order_id) from v_orders)"
    ),
    "defect_late_arrival": _after(
        _one_order("late_arrival", status="delivered", at=f"({AS_OF} - interval 45 day)")
    ),
    "defect_volume_spike": _after(_burst(NEXT_ORDER)),
    "defect_schema_drift": f"select {ORDER_COLUMNS} from v_orders".replace("customer_id", "customer_id as user_id", 1),
    "defect_orphan_payment": f"""select {PAYMENT_COLUMNS} from (select * from v_payments union all
        select (select max(payment_id) + 1 from v_payments), 999999999, 'credit_card', cast(10 as decimal(12,2)),
        'captured', {AS_OF})""",
    "defect_recurring_incident": _after(_one_order("recurring_incident", unit_price="-19.99")),
    "defect_ambiguous_anomaly": f"""select order_id, status, o.product_id, cast(h.unit_price as double) as list_price
        from ({CANCELLED}) o join ({HALVED}) h on h.product_id = o.product_id""",
    "defect_destructive_fix": f"select {ORDER_COLUMNS} from ({_update('total_amount=0', LATEST.format(n=300))})",
    "defect_malformed_data": f"""select {ORDER_COLUMNS} from (
        {_update("status='" + defects.GARBAGE_STATUS + "'", LATEST.format(n=25))})""",
    "defect_slow_source": f"select {ORDER_COLUMNS} from v_orders where ordered_at < {AS_OF} - interval 10 minute",
    "defect_multi_failure_cascade": (
        f"select {ORDER_COLUMNS} from (select * from v_orders union all "
        f"{_one_order('missing_customer', customer=False)} union all {_burst('1 + ' + NEXT_ORDER)})"
    ).replace("customer_id", "customer_id as user_id", 1),
    "traffic_orders": f"""select {ORDER_COLUMNS} from (
        select order_id, c.customer_id, p.product_id, quantity, unit_price,
          cast(unit_price * quantity as decimal(12,2)) as total_amount, d.status, {AS_OF} as ordered_at
        from (select order_id, {_draw('buyer', 'order_id')} % least({TRAFFIC}, (select count(*) from v_customers)) as buyer,
            {_draw('item', 'order_id')} % least({TRAFFIC}, (select count(*) from v_products)) as item,
            cast({_draw('quantity', 'order_id')} % 6 + 1 as int) as quantity,
            {_pick(ORDER_STATUSES, 'status', 'order_id')} as status
          from (select {NEXT_ORDER} + unnest(range({TRAFFIC})) as order_id)) d
        join {_sample('v_customers', 'customer_id', TRAFFIC, 'traffic customers')} c on c.slot = buyer
        join {_sample('v_products', 'product_id', TRAFFIC, 'traffic products')} p on p.slot = item)""",
    "synth_customers": f"select {CUSTOMER_COLUMNS} from s_customers",
    "synth_products": f"select {PRODUCT_COLUMNS} from s_products",
    "synth_orders": f"select {ORDER_COLUMNS} from s_orders",
    "synth_payments": f"select {PAYMENT_COLUMNS} from s_payments",
    "stream_daily_revenue": f"""select {_day('ordered_at')} as day, {REVENUE},
        {_cents('sum(total_amount)', 'count(*)')} as aov from (select * from v_orders qualify row_number() over (
        partition by customer_id, product_id, ordered_at order by order_id) = 1) group by 1""",
    "synced_orders": f"select {ORDER_COLUMNS} from y_orders",
    "synced_fct_orders": f"with {SYNCED_FACTS} {FACT_COLUMNS}",
    "synced_revenue_cuts": f"with {SYNCED_FACTS} "
    + " union all ".join(
        [_cut("day", _day("ordered_at"))] + [_cut(name, name) for name in ("category", "segment", "country")]
    ),
    "synced_daily_revenue": f"""select {_day('ordered_at')} as day, {REVENUE},
        {_cents('sum(total_amount)', 'count(*)')} as aov from y_kept group by 1""",
    "stream_freshness": f"""select 0 as batch_id, 'orders' as table_name, {_moment('max(ordered_at)')} as newest_at,
        epoch_us({AS_OF}) // 1000000 - epoch_us(max(ordered_at)) // 1000000 as lag_seconds,
        epoch_us({AS_OF}) // 1000000 - epoch_us(max(ordered_at)) // 1000000 <= 300 as fresh from v_orders where ordered_at <= {AS_OF}""",
    "stream_dedup": f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_moment('o_orderdate')} as o_orderdate,
        o_orderpriority from orders""",
    "stream_order_rate": f"""select {_moment("date_trunc('hour', ts)")} as window_start,
        {_moment("date_trunc('hour', ts) + interval 1 hour")} as window_end, count(*) as rows from events
        group by date_trunc('hour', ts)""",
}


def oracle_sql() -> dict[str, str]:
    """SQL per query name."""
    return {name: _with(text) for name, text in SQL.items()}
