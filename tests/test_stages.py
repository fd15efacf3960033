"""All stages over generated files, against a plain Python reading of the rules."""

from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import AnalysisException

from booking_files import write_files
from conftest import rows
from lodgemart.plans.top_lists import write_report
from lodgemart.plans.stages import Job, run_all, run_bronze, run_gold, run_silver
from lodgemart.sources.ingest import BOOKING_TABLES, TableSpec, ingest
from lodgemart.sources.layers import PathLayer, TableLayer
from lodgemart.sources.readers import read_csv

LEXICON = {"great": 3, "bad": -3, "not bad": 2, "awful": -4}
CENT, TENTH = Decimal("0.01"), Decimal("0.0001")


def clean(lines):
    """Bookings as the rules leave them, by id."""
    out = {}
    for b in lines:
        days = sorted(d for d in b[5:7] if isinstance(d, date))
        total = Decimal(b[9]) if b[9] is not None else None
        out[b[0]] = {
            "customer": b[1], "hotel": b[2], "room": b[3],
            "in": days[0] if days else None, "out": days[-1] if days else None,
            "total": total if total is None or total >= 0 else None,
            "swapped": len(days) == 2 and b[5] > b[6],
            "status": b[10], "source": b[11],
        }
    return out


def half_up(value, unit):
    return value.quantize(unit, ROUND_HALF_UP)


@pytest.fixture(scope="module", params=["files", "tables"])
def run(request, spark, tmp_path_factory):
    base = tmp_path_factory.mktemp(f"run_{request.param}")
    raw = base / "raw"
    raw.mkdir()
    lines = write_files(str(raw))
    names = ("bronze", "silver", "gold", "report")
    if request.param == "files":
        job = Job(str(raw), *[PathLayer(spark, str(base / n)) for n in names])
    else:
        layers = [TableLayer(spark, f"stay_{n}", location=str(base / n)) for n in ("raw", *names)]
        for name, spec in {**BOOKING_TABLES, "reviews": TableSpec("reviews.csv")}.items():
            layers[0].prepare()
            layers[0].write(read_csv(spark, f"{raw}/{spec.file}", spec.schema), name)
        job = Job(*layers, reviews="reviews")
    counts, skipped = run_all(spark, job, LEXICON, datetime(2024, 6, 1))
    return lines, job, counts, skipped


def test_every_table_is_loaded_and_no_section_skipped(run):
    lines, job, counts, skipped = run
    assert counts == {n: len(lines[n]) for n in counts} and len(counts) == 5
    assert skipped == {}
    assert job.bronze.read("hotels").columns[-1] == "ingestion_date"


def test_master_tables(run):
    _, job, _, _ = run
    assert rows(job.silver.read("hotels"), "hotel_id") == [("H2",), ("H3",), ("H4",)]
    assert job.silver.read("rooms").count() == 12
    customers = job.silver.read("customers")
    assert customers.count() == 20
    assert customers.filter("email is null").count() == 16


def test_bookings(run):
    lines, job, _, _ = run
    expected = clean(lines["bookings"])
    got = job.silver.read("bookings").collect()
    assert len(got) == len(expected)
    for b in got:
        want = expected[b.booking_id]
        assert (b.checkin_date, b.checkout_date) == (want["in"], want["out"])
        assert (b.total_amount, b.dq_swapped_dates) == (want["total"], want["swapped"])
    marked = {b.booking_id for b in got if b.dq_negative_total}
    assert marked == {b[0] for b in lines["bookings"] if b[9] and b[9].startswith("-")} != set()
    foreign = {b.booking_id for b in got if b.dq_invalid_currency}
    assert foreign == {b[0] for b in lines["bookings"] if b[8] == "XXX"}


def test_payments(run):
    lines, job, _, _ = run
    parents = clean(lines["bookings"])
    got = {p.payment_id: p for p in job.silver.read("payments").collect()}
    assert len(got) == 100
    over = 0
    for line in lines["payments"]:
        p, parent = got[line[0]], parents.get(line[1])
        total = parent["total"] if parent else None
        assert p.dq_orphan_payment == (parent is None)
        assert p.bk_total_amount == total
        assert p.dq_over_amount == (total is not None and Decimal(line[4]) > total)
        assert p.dq_invalid_currency == (line[5] == "ZZZ")
        over += p.dq_over_amount
    assert over > 0


def test_gold(run):
    lines, job, _, _ = run
    booked = clean(lines["bookings"])
    daily, per_customer, totals = defaultdict(Decimal), defaultdict(list), defaultdict(Decimal)
    for b in booked.values():
        if b["total"] is None:
            continue
        totals[b["hotel"]] += b["total"]
        per_customer[b["customer"]].append(b["total"])
        if b["status"] == "confirmed":
            daily[b["in"]] += b["total"]
    revenue = {r.date: r.gross_revenue for r in job.gold.read("daily_revenue").collect()}
    assert revenue == daily
    value = {r.customer_id: r for r in job.gold.read("customer_value").collect()}
    assert set(value) == set(per_customer)
    for customer, amounts in per_customer.items():
        r = value[customer]
        assert (r.bookings_count, r.revenue_sum) == (len(amounts), sum(amounts))
        assert r.avg_ticket == half_up(sum(amounts) / len(amounts), CENT)
    paid = defaultdict(Decimal)
    for p in job.silver.read("payments").collect():
        if not (p.dq_orphan_payment or p.dq_over_amount or p.dq_invalid_currency):
            if booked[p.booking_id]["total"] is not None:
                paid[booked[p.booking_id]["hotel"]] += p.amount
    rates = {r.hotel_id: r.collection_rate for r in job.gold.read("collection_rate").collect()}
    assert rates == {h: half_up(paid[h] / t, TENTH) for h, t in totals.items()}


def test_cancellations(run):
    lines, job, _, _ = run
    by_source = defaultdict(list)
    for b in lines["bookings"]:
        by_source[b[11]].append(b[10] == "cancelled")
    got = {r.source: r for r in job.gold.read("cancellation_rate_by_source").collect()}
    assert {s: (r.total_bookings, r.cancelled) for s, r in got.items()} == {
        s: (len(c), sum(c)) for s, c in by_source.items()
    }


def test_alerts(run):
    lines, job, _, _ = run
    stays = [(i, b) for i, b in clean(lines["bookings"]).items() if b["in"] is not None]
    expected = set()
    for i, (one, a) in enumerate(stays):
        for two, b in stays[i + 1 :]:
            if a["room"] == b["room"] and max(a["in"], b["in"]) < min(a["out"], b["out"]):
                expected.add((a["room"], *sorted((one, two)), max(a["in"], b["in"]), min(a["out"], b["out"])))
    got = rows(job.gold.read("overbooking_alerts"))
    assert set(got) == expected and len(got) == len(expected) > 10


def test_sentiment(run):
    lines, job, _, _ = run
    scored = job.gold.read("reviews_sentiment")
    assert scored.columns == ["customer_id", "review_text", "sentiment_score", "predicted_sentiment"]
    scores = {"great stay": 3.0, "bad, bad room": -6.0, "fine": 0.0, None: 0.0,
              "Great! not bad": 5.0, "awful": -4.0, "great": 3.0}
    got = scored.collect()
    assert len(got) == len(lines["reviews"])
    assert all(r.sentiment_score == scores[r.review_text] for r in got)
    enriched = {r.customer_id: r.avg_sentiment_score for r in job.gold.read("customer_value_enriched").collect()}
    by_customer = defaultdict(list)
    for customer, text in lines["reviews"]:
        by_customer[customer].append(scores[text or None])
    for customer, average in enriched.items():
        mine = by_customer.get(customer, [0.0])
        assert average == pytest.approx(sum(mine) / len(mine))
    assert set(enriched) - set(by_customer)


def test_report(run):
    _, job, _, _ = run
    top = job.report.read("top_customers")
    assert top.count() == min(20, job.gold.read("customer_value_enriched").count())
    assert job.report.read("top_collection").count() == 4
    assert job.report.read("daily_revenue").count() == job.gold.read("daily_revenue").count()
    assert job.report.read("cancellation_rate").count() == 3


def test_report_skips_what_is_missing(spark, tmp_path):
    gold, report = PathLayer(spark, str(tmp_path / "gold")), PathLayer(spark, str(tmp_path / "report"))
    value = spark.createDataFrame([("c1", 5.0)], "customer_id string, revenue_sum double")
    gold.write(value, "customer_value_enriched")
    skipped = write_report(gold, report)
    assert set(skipped) == {"daily_revenue", "cancellation_rate", "top_collection"}
    assert report.read("top_customers").count() == 1


def test_report_raises_what_is_not_a_missing_table(spark, tmp_path):
    gold, report = PathLayer(spark, str(tmp_path / "gold")), PathLayer(spark, str(tmp_path / "report"))
    gold.write(spark.createDataFrame([("c1",)], "customer_id string"), "customer_value_enriched")
    with pytest.raises(AnalysisException):
        write_report(gold, report)


def test_malformed_values_are_marked_and_counted(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_files(str(raw))
    lines = (raw / "bookings.csv").read_text().splitlines()
    header = lines[0].split(",")
    first, second = lines[1].split(","), lines[2].split(",")
    first[header.index("checkin_date")] = "13/05/2024"
    second[header.index("total_amount")] = "99999999999.00"
    (raw / "bookings.csv").write_text("\n".join([lines[0], ",".join(first), ",".join(second), *lines[3:]]) + "\n")
    layers = [PathLayer(spark, str(tmp_path / n)) for n in ("bronze", "silver", "gold", "report")]
    job = Job(str(raw), *layers, reviews=None)
    run_bronze(spark, job)
    marks = run_silver(job)
    got = {r.booking_id: r for r in job.silver.read("bookings").collect()}
    assert got[first[0]].dq_bad_checkin and not got[second[0]].dq_bad_checkin
    assert got[second[0]].dq_bad_total and got[second[0]].total_amount is None
    assert marks["bookings"]["dq_bad_total"] == 1
    assert marks["bookings"]["dq_bad_checkin"] == 1 + sum("not a date" in x for x in lines)
    assert marks["payments"]["dq_bad_amount"] == 0 < marks["payments"]["dq_over_amount"]


def test_job_passes_its_options_on(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_files(str(raw))

    def gold(name, **options):
        layers = [PathLayer(spark, str(tmp_path / name / n)) for n in ("bronze", "silver", "gold", "report")]
        job = Job(str(raw), *layers, reviews=None, **options)
        run_bronze(spark, job)
        run_silver(job)
        run_gold(job)
        return job

    plain = gold("plain")
    other = gold(
        "other", exclude_status=["cancelled"], confirmed_only=True, status_in=["no such"], currencies=["USD"], splits=3,
        null_bounds="open", bucket_days=2, bad_date_flags=(None, None), bad_total_flag=None, bad_amount_flag=None,
    )
    assert other.gold.read("overbooking_alerts").count() < plain.gold.read("overbooking_alerts").count()
    assert other.gold.read("customer_value").agg({"revenue_sum": "sum"}).first() < plain.gold.read(
        "customer_value"
    ).agg({"revenue_sum": "sum"}).first()
    assert {r.collection_rate for r in other.gold.read("collection_rate").collect()} == {0}
    assert "dq_bad_checkin" in plain.silver.read("bookings").columns
    assert "dq_bad_checkin" not in other.silver.read("bookings").columns


def test_places_that_are_the_same_are_refused(spark, tmp_path):
    """Before anything is written, and with the input still there."""
    base = str(tmp_path)
    raw = tmp_path / "raw" / "t"
    raw.mkdir(parents=True)
    (raw / "a.csv").write_text("id\n1\n")
    with pytest.raises(ValueError):
        ingest(spark, f"{base}/raw", PathLayer(spark, f"{base}/raw"), {"t": TableSpec("t")})
    assert (raw / "a.csv").read_text() == "id\n1\n"
    away = [PathLayer(spark, f"{base}/{n}") for n in ("l1", "l2")]
    pairs = [
        (PathLayer(spark, f"{base}/x/a"), PathLayer(spark, f"file:{base}/x/a")),
        (PathLayer(spark, f"{base}/x/a"), PathLayer(spark, f"{base}/x/b/../a")),
        (TableLayer(spark, "same"), TableLayer(spark, "same", catalog="spark_catalog")),
        (TableLayer(spark, "same"), TableLayer(spark, "SAME")),
        (TableLayer(spark, "there", location=f"{base}/y"), PathLayer(spark, f"{base}/y")),
    ]
    for one, two in pairs:
        with pytest.raises(ValueError):
            Job(f"{base}/raw", one, two, *away)
    with pytest.raises(ValueError):
        Job(f"{base}/raw", *away, PathLayer(spark, f"{base}/l3"), PathLayer(spark, f"{base}/raw/"), specs={"t": TableSpec("t")})


def test_a_layer_refuses_to_overwrite_what_a_frame_reads(spark, tmp_path):
    layer = PathLayer(spark, str(tmp_path / "l"))
    layer.write(spark.range(3), "t")
    with pytest.raises(ValueError):
        layer.write(layer.read("t").filter("id > 0"), "t")
    assert layer.read("t").count() == 3
    tables = TableLayer(spark, "kept", location=str(tmp_path / "kept"))
    tables.prepare()
    tables.write(spark.range(3), "t")
    with pytest.raises(ValueError):
        tables.write(tables.read("t").filter("id > 0"), "t")
    assert tables.read("t").count() == 3


def test_job_refuses_overlapping_layers(spark, tmp_path):
    same = PathLayer(spark, str(tmp_path))
    with pytest.raises(ValueError):
        Job("raw", same, same, same, same)


def test_ingest_refuses_its_own_target(spark, tmp_path):
    layer = PathLayer(spark, str(tmp_path))
    with pytest.raises(ValueError):
        ingest(spark, layer, layer)
