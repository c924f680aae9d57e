"""Registered queries do their whole job, on rows built here."""

from __future__ import annotations

import datetime

import parity

import __spark_entry__ as registry
from tillmark.operators import quality as q
from tillmark.sources import contracts, retail_views as views, tables


def write(spark, folder, **rows):
    for name, own in rows.items():
        frame = spark.createDataFrame(own, views.SCHEMAS[name])
        frame.coalesce(1).write.parquet(f"{folder}/files/{name}")
        part, = (folder / "files" / name).glob("*.parquet")
        part.rename(folder / f"{name}.parquet")
    return str(folder)


def line(order, number=1, part=1, supplier=1, quantity=2.0, price=20.0, day=1):
    shipped = datetime.datetime(1999, 1, day)
    return (order, part, supplier, number, quantity, price, 0.05, 0.0, "N", "O", shipped)


def test_price_line_draws_prices_and_discounts(spark, tmp_path):
    parts = [(n, f"part {n}", "brand", "SMALL", n, 100.0 * n + 0.35) for n in range(1, 6)]
    lines = [line(n // 4, n % 4, 1 + n % 6, quantity=1.0 + n % 7) for n in range(400)]
    lines += [line(None), line(3, None), line(3, part=None), line(5, quantity=None)]
    folder = write(spark, tmp_path, part=parts, lineitem=lines)
    df = registry.queries()["price_line"](spark, folder)
    assert parity.differences(df, parity.connect(folder), registry.oracle_sql()["price_line"]) == []
    rows = df.collect()
    assert len(rows) == sum(1 + n % 6 <= 5 for n in range(400)) + 3
    rows = [r for r in rows if r["unit_price"] is not None]
    assert {r["discount_rate"] for r in rows} == {0.0, 0.10, 0.15, 0.20, 0.30}
    assert {r["listed_rate"] for r in rows} == {0.05}
    spreads = [r["unit_price"] / r["listed_price"] for r in rows]
    assert min(spreads) < 0.97 and max(spreads) > 1.03 and 0.949 < min(spreads) < max(spreads) < 1.051


def test_contact_details_are_drawn_for_every_customer(spark, tmp_path):
    people = [(n, f"Customer#{n:09d}", n % 7, 1.0, "BUILDING") for n in range(1, 200)]
    people += [(7, "Customer#000000007", None, 1.0, "BUILDING"), (None, "Ann#Lee", 0, 1.0, None)]
    folder = write(spark, tmp_path, customer=people)
    df = registry.queries()["contact_details"](spark, folder)
    sql = registry.oracle_sql()["contact_details"]
    assert parity.differences(df, parity.connect(folder), sql) == []
    rows = df.collect()
    assert len(rows) == 201
    assert all(r["phone"].startswith("04") for r in rows if r["customer_id"] is not None)
    assert {r["postcode"][0] for r in rows if r["postcode"]} == {"2", "3", "4", "5"}
    assert {r["region_type"] for r in rows} == {"Metro", "Regional"}
    row, = [r for r in rows if r["customer_id"] == 12]
    assert row["email"] == "customer.00000001212@example.com.au"
    assert (row["initials"], row["mail_host"], row["short_code"]) == ("C0", "example.com.au", "0012")


def odd_tables():
    """Sales whose keys are NULL, lost or repeated, and customers whose rows repeat."""
    day = datetime.datetime(1995, 1, 2)
    people = [(n, f"Customer#{n}", 0, 1.0, "None") for n in (1, 2, 2, 3, 4)]
    people += [(3, "Customer#33", 0, 1.0, None), (None, "Customer#9", 0, 1.0, "None")]
    orders = [(n, n % 6, "O", 1.0, day, "1-URGENT") for n in range(1, 30)]
    orders += [(7, 2, "O", 1.0, day, None), (8, None, "O", 1.0, day, "Cash"), (None, 1, "O", 1.0, day, "Cash")]
    lines = [line(n, k, part=n % 4, supplier=k, day=1 + n) for n in range(1, 31) for k in (1, 2)]
    lines += [line(5, 1), line(7, 1, part=None), line(None), line(9, 3, quantity=None, price=None)]
    lines = [(*row[:10], None if n % 9 == 0 else datetime.datetime(1994, 7, 1) + datetime.timedelta(11 * n))
             for n, row in enumerate(lines)]
    return {
        "customer": people, "orders": orders, "lineitem": lines,
        "nation": [(0, "NSW", 0)], "region": [(0, "ASIA")],
        "part": [(n, f"part {n}", "b", "SMALL", 1, 1.0) for n in (1, 2, 2)],
        "supplier": [(1, "shop", 0, 1.0), (None, "none", 0, 1.0)],
    }


def checked_apart(frames, as_of):
    """The reports on transactions, each check by itself over the joined rows."""
    sales, table = frames["transactions"], contracts.TRANSACTIONS
    reports = [q.check_rows(sales, "transactions", q.contract_checks(table, as_of), 1),
               q.check_unique(sales, "transactions", ["transaction_id"])]
    for column, (parent, own) in table.foreign_keys.items():
        reports.append(q.check_references(sales, "transactions", column, frames[parent], own))
    reports.append(
        q.check_date_order(sales, "transactions", "customer_id", "transaction_date",
                           frames["customers"], "customer_id", "signup_date")
    )
    return parity.bag(q.all_reports(reports))


def test_contract_report_scans_the_sales_once(spark, tmp_path, small_limits):
    folder = write(spark, tmp_path, **odd_tables())
    report = registry.queries()["dq_contract_report"](spark, folder)
    plan = report._jdf.queryExecution().executedPlan().toString()
    frames = registry._contract_frames(spark, folder)
    ready = {n: tables.conform(f, contracts.TABLES[n]) for n, f in frames.items()}
    got = [row for row in parity.bag(report) if row[1] == "transactions"]
    assert got == checked_apart(ready, registry.AS_OF)
    early, = [row for row in got if row[0] == "date_order"]
    assert early[3] > early[4] > 0
    whole = parity.bag(q.check_tables(ready, registry.AS_OF))
    assert whole == parity.bag(report)
    assert plan.count("FileScan parquet [l_orderkey") == plan.count("FileScan parquet [o_orderkey") == 1


def test_integrity_suite_scans_the_sales_once(spark, tmp_path, small_limits):
    folder = write(spark, tmp_path, **odd_tables())
    report = registry.queries()["dq_integrity_suite"](spark, folder)
    plan = report._jdf.queryExecution().executedPlan().toString()
    frames = registry._retail(spark, folder, views.transactions)
    plain = q.integrity_suite(frames, registry.AS_OF, states=["NATION_1", "NATION_2", "NATION_3"])
    assert parity.bag(report) == parity.bag(plain)
    got = {row[:3]: row[3:5] for row in parity.bag(report)}
    sales = views.transactions(spark, folder)
    for column, (parent, own) in contracts.TRANSACTIONS.foreign_keys.items():
        lost = q.check_references(sales, "transactions", column, frames[parent], own).first()
        assert got["references", "transactions", column] == tuple(lost[3:5])
    assert plan.count("FileScan parquet [l_orderkey") == plan.count("FileScan parquet [o_orderkey") == 1
