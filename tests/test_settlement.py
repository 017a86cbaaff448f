"""Settlement files: scan, rules in order, file errors and the whole job."""

import json
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivermark.operators import inventory, settlement
from rivermark.operators.contract import ContractError, load_contract
from rivermark.plans.settlements import run_settlements
from rivermark.schemas import SETTLEMENT
from rivermark.sinks import read_gates, read_output, read_runs
from rivermark.sources import settlement_files as source

CONTRACT = load_contract()
HEADER = ",".join(CONTRACT.names)
AT = datetime(2026, 7, 22, 12, tzinfo=UTC)


def row(n=1, **changes):
    values = {
        "partner_id": "VCB",
        "settlement_date": "2026-07-22",
        "settlement_reference": f"S-{n}",
        "partner_transaction_reference": f"P-{n}",
        "internal_transaction_id": "",
        "transaction_timestamp": "2026-07-22T10:00:00+07:00",
        "amount": "100.00",
        "currency": "USD",
        "settlement_status": "SETTLED",
        "fee_amount": "1.50",
        "net_amount": "98.50",
    }
    values.update(changes)
    return ",".join(values.values())


def write(folder, lines, name="settlement_VCB_2026-07-22_001.csv", end="\n"):
    folder.mkdir(exist_ok=True)
    text = lines if isinstance(lines, (bytes, str)) else end.join([HEADER, *lines]) + end
    (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return folder


def judge(spark, folder, contract=CONTRACT):
    rows, files = source.read_settlements(spark, str(folder), contract)
    marked = settlement.mark_file_duplicates(rows, contract)
    return settlement.validate_rows(marked, contract), files


def codes(spark, folder):
    judged, _ = judge(spark, folder)
    return {r["source_row_number"]: r["error_code"] for r in judged.collect()}


def test_rules(spark, tmp_path):
    cases = [
        (row(1), None),
        (row(2, amount="-5.00", net_amount="-6.50"), "AMOUNT_NOT_POSITIVE"),
        (row(3, currency="usd"), "INVALID_CURRENCY"),
        (row(4, settlement_status="UNKNOWN"), "INVALID_SETTLEMENT_STATUS"),
        (row(5, net_amount="99.99"), "NET_AMOUNT_INCONSISTENT"),
        (row(6, partner_transaction_reference="  "), "REQUIRED_FIELD_EMPTY"),
        (row(7, transaction_timestamp="2026-07-22T10:00:00"), "TIMESTAMP_TIMEZONE_REQUIRED"),
        (row(8, transaction_timestamp="noon"), "INVALID_TRANSACTION_TIMESTAMP"),
        (row(9, amount="not-a-decimal"), "INVALID_DECIMAL"),
        (row(10, amount="100.001"), "DECIMAL_SCALE_EXCEEDED"),
        (row(11, amount="1234567890123456789"), "DECIMAL_PRECISION_EXCEEDED"),
        (row(1), "DUPLICATE_ROW"),
        (row(1, amount="101.50", net_amount="100.00"), "DUPLICATE_SETTLEMENT_REFERENCE"),
        (row(14, partner_id="vcb"), "INVALID_PARTNER_ID|PARTNER_MISMATCH"),
        (row(15, settlement_date="2026-07-21"), "SETTLEMENT_DATE_MISMATCH"),
        (row(16, settlement_date="22/07/2026"), "INVALID_SETTLEMENT_DATE"),
        (row(17, internal_transaction_id="x"), "INVALID_INTERNAL_TRANSACTION_ID"),
        (row(18, fee_amount="-1.00", net_amount="101.00"), "NEGATIVE_FEE_AMOUNT"),
        (row(19, settlement_reference="r" * 129), "MAX_LENGTH_EXCEEDED"),
        (row(20, amount="NaN", fee_amount="1E-1", net_amount=""), "REQUIRED_FIELD_EMPTY|INVALID_DECIMAL"),
        (row(21, amount="1E2"), None),
        (row(22).rsplit(",", 2)[0], "REQUIRED_FIELD_MISSING"),
        (row(23) + ",extra", None),
        (row(24, internal_transaction_id="{22A08D63CFFC4D368A83A7B0D31C9F16}"), None),
    ]
    folder = write(tmp_path / "in", [c[0] for c in cases])
    assert codes(spark, folder) == {n: c[1] for n, c in enumerate(cases, start=2)}
    judged, _ = judge(spark, folder)
    typed = judged.where("source_row_number = 25").select("typed.*").first()
    assert typed["internal_transaction_id"] == "22a08d63-cffc-4d36-8a83-a7b0d31c9f16"
    assert typed["amount"] == Decimal("100.00")


def test_quoted_line_breaks_and_blank_lines(spark, tmp_path):
    lines = [
        row(1, settlement_reference='"a\nb"'),
        "",
        row(2, settlement_reference='"say ""hi"", x"'),
        row(3, partner_transaction_reference='"one\n\ntwo\nthree"'),
        row(4),
    ]
    folder = write(tmp_path / "in", lines, end="\r\n")
    judged, files = judge(spark, folder)
    got = {r["source_row_number"]: r for r in judged.collect()}
    assert [got[n]["error_code"] for n in (2, 3, 4, 5)] == [None] * 4
    assert got[2]["settlement_reference"] == "a\nb"
    assert got[3]["settlement_reference"] == 'say "hi", x'
    assert got[4]["partner_transaction_reference"] == "one\n\ntwo\nthree"
    assert files.first()["record_count"] == 4


def test_small_blocks_give_the_same_rows(spark, tmp_path):
    lines = [row(n) if n % 7 else row(n, settlement_reference=f'"x\n{n}"') for n in range(1, 60)]
    folder = write(tmp_path / "in", lines)

    def read():
        rows, files = source.read_settlements(spark, str(folder), CONTRACT)
        data = [tuple(r)[1:] for r in rows.orderBy("source_row_number").collect()]
        return data, source.read_lines(spark, str(folder)).select("_block").distinct().count()

    whole, one = read()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cut, many = read()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert one == 1 and many > 5
    assert whole == cut and len(whole) == 59


FILES = {
    "settlement_VCB_2026-07-22_001.csv": (HEADER + "\n" + row(1) + "\n", None),
    "settlement_VCB_2026-07-22_002.csv": (HEADER + "\n", "EMPTY_FILE"),
    "settlement_VCB_2026-07-22_003.csv": ("", "EMPTY_FILE"),
    "settlement_VCB_2026-07-22_004.csv": (HEADER.replace("fee_amount,", "") + "\nx\n", "INVALID_FILE_SCHEMA"),
    "settlement_VCB_2026-07-22_005.csv": (HEADER.encode() + b"\n" + b"\xff,\n", "INVALID_ENCODING"),
    "settlement_VCB_2026-07-22_006.csv": (HEADER + '\n"open,1\n2,3\n', "INVALID_CSV"),
    "settlement_VCB_2026-07-22_007.csv": (HEADER + '\n"a"b,1\n', "INVALID_CSV"),
    "settlement_VCB_2026-07-22_000.csv": (HEADER + "\n" + row(1) + "\n", "INVALID_FILE_SEQUENCE"),
    "settlement_VCB_2026-02-30_001.csv": (HEADER + "\n", "INVALID_SETTLEMENT_DATE"),
    "settlement_ABC_2026-07-22_001.csv": (HEADER + "\n" + row(1) + "\n", "PARTNER_FILE_NAME_MISMATCH"),
    "settlement_VCB_2026-07-22_001.txt": ("x", "INVALID_EXTENSION"),
    "notes.csv": ("x", "INVALID_FILE_NAME"),
}


def test_file_errors(spark, tmp_path):
    for name, (text, _) in FILES.items():
        write(tmp_path / "in", text, name=name)
    rows, files = source.read_settlements(spark, str(tmp_path / "in"), CONTRACT, expected_partner="VCB")
    assert {r["file_name"]: r["error_code"] for r in files.collect()} == {n: c for n, (_, c) in FILES.items()}
    assert rows.select("source_file_name").distinct().count() == 1


def in_blocks(spark, size):
    """Settings that cut files into splits of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


def test_content_ids(spark, tmp_path):
    """One function of the bytes, whatever the splits are; line ends and marks count."""
    import hashlib

    many = "".join(f"line {n}\r\n" for n in range(10_000)).encode()
    texts = [b"a\nb\n", b"b\na\n", b"a\nb", b"a\r\nb\r\n", b"\xef\xbb\xbfa\nb\n", b"a\n\xff\n", b"\n", many]
    for n, text in enumerate(texts):
        write(tmp_path / "in", text, name=f"{n}.csv")
    write(tmp_path / "in", texts[0], name="8.csv")

    def by_hand(text):
        bare = text.removeprefix(b"\xef\xbb\xbf")
        lines = (bare[:-1] if bare.endswith(b"\n") else bare).split(b"\n")
        hashes = [hashlib.sha256(x).hexdigest().upper() for x in lines]
        parts = [hashlib.sha256("".join(hashes[k : k + 4096]).encode()).hexdigest() for k in range(0, len(hashes), 4096)]
        return hashlib.sha256(f"{len(text)}:{''.join(parts)}".encode()).hexdigest()

    def ids():
        return {r["path"][-5]: (r["checksum_sha256"], r["has_bom"]) for r in source.content_ids(spark, str(tmp_path / "in")).collect()}

    got = ids()
    assert got == {str(n): (by_hand(t), n == 4) for n, t in enumerate([*texts, texts[0]])}
    assert len(set(got.values())) == len(texts)
    in_blocks(spark, 9000)
    try:
        assert ids() == got
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_raw_blocks_are_the_bytes(spark, tmp_path):
    long = "".join(f"{n},{'x' * 90}\r\n" for n in range(30_000)).encode()
    texts = {"a.csv": long, "b.csv": b"", "c.csv": b"\xef\xbb\xbf", "d.csv": b"\xef\xbb\xbfa\n\nb", "e.csv": b"\n\xff\n", "f +%.csv": b"x"}
    for name, text in texts.items():
        write(tmp_path / "in", text, name=name)
    files = source.identify_files(spark, str(tmp_path / "in"), CONTRACT)
    rows = source.raw_blocks(spark, str(tmp_path / "in"), files).orderBy("file_name", "block").collect()
    got = {}
    for r in rows:
        got[r["file_name"]] = got.get(r["file_name"], b"") + r["content"]
    assert got == texts
    assert sum(r["file_name"] == "a.csv" for r in rows) == 3


def test_marks_and_long_fields(spark, tmp_path):
    """A byte order mark is no header; a field above the limit refuses the file, torn or not."""
    limit = source.FIELD_LIMIT
    head = "settlement_VCB_2026-07-22_0"
    texts = {
        "01": "\ufeff" + HEADER + "\n" + row(1) + "\n",
        "02": HEADER + "\n" + row(settlement_reference="x" * limit) + "\n",
        "03": HEADER + "\n" + row(settlement_reference="x" * (limit + 1)) + "\n",
        "04": HEADER + "\n" + row(settlement_reference='"' + "x" * (limit - 2) + '\n""' + '"') + "\n",
        "05": HEADER + "\n" + row(settlement_reference='"' + "x" * (limit - 1) + '\n""' + '"') + "\n",
    }
    for number, text in texts.items():
        write(tmp_path / "in", text, name=f"{head}{number}.csv")
    _, files = source.read_settlements(spark, str(tmp_path / "in"), CONTRACT)
    got = {r["file_name"][len(head) :][:2]: r["error_code"] for r in files.collect()}
    assert got == {"01": "INVALID_FILE_SCHEMA", "02": None, "03": "INVALID_CSV", "04": None, "05": "INVALID_CSV"}


def test_only_pending_files_are_read(spark, tmp_path):
    for n in (1, 2):
        write(tmp_path / "in", [row(n)], name=f"settlement_VCB_2026-07-22_00{n}.csv")
    every = source.identify_files(spark, str(tmp_path / "in"), CONTRACT)
    one = every.where("sequence = 2")
    paths = [r["path"] for r in one.select("path").collect()]
    assert source.read_lines(spark, str(tmp_path / "in"), only=paths).count() == 2
    rows, files = source.read_settlements(spark, str(tmp_path / "in"), CONTRACT, files=one)
    assert [r["settlement_reference"] for r in rows.collect()] == ["S-2"] and files.count() == 1


def run(spark, tmp_path, **options):
    return run_settlements(
        spark,
        inbound=str(tmp_path / "in"),
        silver=str(tmp_path / "silver"),
        raw=str(tmp_path / "raw"),
        ledger_path=str(tmp_path / "ledger"),
        gates_path=str(tmp_path / "gates"),
        partner="VCB",
        at=AT,
        **options,
    )


def test_job(spark, tmp_path):
    for name, (text, _) in FILES.items():
        write(tmp_path / "in", text, name=name)
    write(tmp_path / "in", [row(1), row(2, currency="usd")], name="settlement_VCB_2026-07-22_010.csv")
    trial = run(spark, tmp_path, dry_run=True)
    assert trial.output_record_count == 2 and not (tmp_path / "ledger").exists()
    first = run(spark, tmp_path, run_id="one")
    assert (first.files, first.processed_files, first.output_record_count) == (13, 2, 2)
    assert first.rejected_record_count == 1 + 11 and first.gate == "FAIL"
    accepted = spark.read.parquet(first.outputs[0].path)
    assert {r["source_row_number"] for r in accepted.collect()} == {2}
    rejected = spark.read.parquet(first.outputs[1].path)
    assert rejected.where("raw_reference = 'row:3'").first()["business_key"] == "S-2"
    raw = spark.read.parquet(str(tmp_path / "raw/files"))
    name = "settlement_VCB_2026-07-22_005.csv"
    assert raw.where(F.col("file_name") == name).first()["content"] == FILES[name][0]
    evidence = spark.read.json(str(tmp_path / "raw/rejected/run_id=one")).first()
    assert json.loads(evidence["raw_record"])["currency"] == "usd"
    gates = read_gates(spark, str(tmp_path / "gates")).collect()
    assert [(r["run_id"], r["rule_name"], r["classification"]) for r in gates] == [("one", "rejection_rate", "FAIL")]
    assert read_output(spark, str(tmp_path / "ledger"), "settlements", SETTLEMENT).count() == 2
    again = run(spark, tmp_path, run_id="two")
    assert again.status == "SKIPPED"
    forced = run(spark, tmp_path, run_id="three", force=True, strict=True)
    assert forced.processed_files == 1 and forced.output_record_count == 1
    states = read_runs(spark, str(tmp_path / "ledger")).where("run_id = 'one'")
    assert {r["status"]: r["n"] for r in states.groupBy("status").agg(F.count("*").alias("n")).collect()} == {
        "COMPLETED": 2,
        "QUARANTINED": 11,
    }


def test_contract_checks(tmp_path):
    text = json.loads(source_text())
    assert load_contract().typed_schema()["amount"].dataType.scale == 2
    broken = [
        lambda c: c["fields"].pop(),
        lambda c: c["file"].update(delimiter=";;"),
        lambda c: c["file"].update(naming_pattern="^x$"),
        lambda c: c["file"].update(business_key=["nope"]),
        lambda c: c["fields"][4].update(nullable=False),
        lambda c: c["fields"][8].update(allowed_values=[]),
        lambda c: c["fields"][6].update(scale=0),
        lambda c: c["fields"][0].update(pattern="["),
        lambda c: c.pop("file"),
    ]
    for n, change in enumerate(broken):
        copy = json.loads(json.dumps(text))
        change(copy)
        path = tmp_path / f"c{n}.json"
        path.write_text(json.dumps(copy))
        with pytest.raises(ContractError):
            load_contract(path)
    with pytest.raises(ContractError):
        load_contract(tmp_path / "none.json")


def test_equal_files_of_one_run_are_settled_once(spark, tmp_path):
    for number in ("001", "002"):
        write(tmp_path / "in", [row(1), row(2)], name=f"settlement_VCB_2026-07-22_{number}.csv")
    result = run(spark, tmp_path)
    assert (result.processed_files, result.duplicate_files, result.output_record_count) == (1, 1, 2)
    assert run(spark, tmp_path).status == "SKIPPED"


def source_text():
    from rivermark.operators.contract import DEFAULT_PATH

    return DEFAULT_PATH.read_text()


def test_backfill_requests():
    good = {"request_id": "22a08d63-cffc-4d36-8a83-a7b0d31c9f16", "source_type": "cdc", "entity": "refunds"}
    request = inventory.backfill_request(good)
    assert request.dry_run and not request.force and request.entity == "refunds"
    for bad in (
        {"request_id": "x"},
        {"source_type": "other"},
        {"entity": "nope"},
        {"source_type": "SETTLEMENT"},
        {"input_prefix": "/abs"},
        {"input_prefix": "a/../b"},
        {"from_date": "2026-01-02", "to_date": "2026-01-01"},
        {"from_date": "soon"},
    ):
        with pytest.raises(ValueError):
            inventory.backfill_request({**good, **bad})
    with pytest.raises(ValueError, match="request_id.*entity.*to_date"):
        inventory.backfill_request({"source_type": "cdc", "entity": "x", "to_date": "soon"})
