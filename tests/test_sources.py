import datetime as dt
import json
import zipfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import store
from tidemark.functions.keys import hash_key_of
from tidemark.operators.promote import ALREADY, APPENDED, PromoteRefused
from tidemark.plans import jobs
from tidemark.sources import extraction, generator, landing, readers
from tidemark.sources.contracts import COLUMNS, TABLES
from tidemark.sources.extraction import ExtractionRefused, Remote, Response, WebDav
from tidemark.sources.generator import PROFILES, Stream, StreamRefused, deliveries, json_lines, refuse_misplaced, validated_pool
from tidemark.sources.landing import LandingRefused
from tidemark.streaming import ingest, measures

POOL = validated_pool(f"{n:08d}" for n in range(1, 41))


# --- readers ------------------------------------------------------------------------------------------------------


def test_csv_keeps_quotes_breaks_and_cp1252(spark, tmp_path):
    record = '"00000001";"A ""B"" ;\nÇÃO";"2062";"10";"1,00";"01";""\r\n00000002;X;2062;10;1,00;01;\r\n'
    (tmp_path / "f.csv").write_bytes(record.encode("cp1252"))
    got = readers.read_csv_batch(spark, str(tmp_path), "empresas").collect()
    assert [r.razao_social for r in got] == ['A "B" ;\nÇÃO', "X"] and got[0].ente_federativo_responsavel in (None, "")


def test_json_lines_rescue_what_the_contract_does_not_declare(spark, tmp_path):
    good = dict.fromkeys(COLUMNS["ptax"], "1")
    lines = [json.dumps(good), json.dumps(good | {"more": 1}), "{broken", "", "[1]", json.dumps({"currency": "é"})]
    (tmp_path / "f.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = readers.read_jsonl_batch(spark, str(tmp_path), "ptax").select("currency", "_rescued_data").collect()
    assert [r._rescued_data is not None for r in got] == [False, True, True, True, True, False] and got[0].currency == "1" and got[5].currency == "é"


def test_snapshot_windows(spark):
    store.append(spark.createDataFrame([("a", "2027-01"), ("b", "2027-02")], "k string, _snapshot_month string"), "s_window")
    assert readers.snapshot_window(spark, "s_window", ["2027-01"]).count() == 1 and readers.snapshot_window(spark, "s_window", None).count() == 2
    for bad in ("2027-01", [], ["2027-1"], ["2027-01", "2027-01"]):
        with pytest.raises(ValueError):
            readers.snapshot_window(spark, "s_window", bad)
    with pytest.raises(ValueError):
        readers.snapshot_window(spark, "s_window", None, column="absent")


def test_lookup_routing(spark):
    names = ["/x/F.K03200.CNAE", "/x/f.munic", "/x/other", None]
    df = spark.createDataFrame([(n,) for n in names], "p string").select(readers.lookup_type(F.col("p")))
    assert [r[0] for r in df.collect()] == ["cnae", "municipio", None, None] == [readers.lookup_type_of(n or "") for n in names]


# --- streaming and jobs -------------------------------------------------------------------------------------------


def write_payments(spark, root, month, name, stream):
    lines = [r[0] for r in json_lines(deliveries(spark, stream)).collect()]
    return landing.emit_file(lines, Path(ingest.landing_dir(str(root), month, TABLES["payments"])) / name)


def stream(**over):
    return Stream(**({"seed": 1, "stream_id": "T", "events": 60, "repeats": 5, "start_ms": 1_785_542_400_000, "interval_ms": 60_000, "lag_ms": 1500, "pool": POOL} | over))


def test_payments_from_generation_to_bronze_exactly_once(spark, tmp_path):
    month = "2026-08"
    args = {"root": str(tmp_path), "month": month, "record_source": "t"}
    job = jobs.bronze_job(spark, "payments", batch_id="b1", prepare=lambda: write_payments(spark, tmp_path, month, "one.jsonl", stream(duplicates=3)), **args)
    done = job.run()
    assert done["prepare"].written and done["gate"] == 0 and done["promote"].outcome == APPENDED and done["promote"].rows == 63
    again = jobs.bronze_job(spark, "payments", batch_id="b1", prepare=lambda: write_payments(spark, tmp_path, month, "one.jsonl", stream(duplicates=3)), **args).run()
    assert not again["prepare"].written and again["promote"].outcome == ALREADY and store.rows_in(spark, "bronze_payments_staging") == 63
    drift = jobs.bronze_job(spark, "payments", batch_id="b2", prepare=lambda: write_payments(spark, tmp_path, month, "two.jsonl", stream(stream_id="U", undeclared_from=40)), **args)
    with pytest.raises(PromoteRefused):
        drift.run()
    assert drift.results["gate"] == 20 and store.rows_of_batch(spark, "bronze_payments_quarantine", "b2") == 20
    assert jobs.repromote(spark, "payments", "b2").rows == 40
    with pytest.raises(ingest.IngestRefused):
        ingest.ingest(spark, TABLES["payments"], root=str(tmp_path), month=month, batch_id="b3", record_source="t", source=str(tmp_path))
    for month_ in ("2026-13", "x", None):
        with pytest.raises(ingest.IngestRefused):
            ingest.require_month(month_)
    with pytest.raises(ingest.IngestRefused):
        ingest.require_batch_id(" ")


def test_registry_from_archive_to_vault(spark, tmp_path):
    table = TABLES["empresas"]
    for month, day, name in (("2026-06", "13", "A"), ("2026-07", "11", "B")):
        archives, target = tmp_path / f"zips-{month}", Path(ingest.landing_dir(str(tmp_path), month, table))
        archives.mkdir()
        inner = f"K.EMPRE.D{month[3]}{month[5:]}{day}"
        with zipfile.ZipFile(archives / "Empresas0.zip", "w") as z:
            z.writestr(inner, f'"00000001";"{name}";"2062";"10";"1,00";"01";""\n00000002;SAME;2062;10;1,00;01;\n'.encode("cp1252"))
        job = jobs.bronze_job(spark, "empresas", root=str(tmp_path), month=month, batch_id=f"e-{month}", record_source="files", prepare=lambda a=archives, t=target: landing.unzip_dir(a, t), reclaim=True)
        done = job.run()
        assert done["promote"].rows == 2 and len(done["reclaim"].deleted) == 1 and not list(target.iterdir())
    got = rows(spark.table("bronze_empresas").select("cnpj_basico", "razao_social", "_snapshot_ref_date"))
    assert got == [("00000001", "A", dt.date(2026, 6, 13)), ("00000001", "B", dt.date(2026, 7, 11)), ("00000002", "SAME", dt.date(2026, 6, 13)), ("00000002", "SAME", dt.date(2026, 7, 11))]
    first = jobs.vault_job(spark, "vault_empresa", load_date="2026-08-01T00:00:00Z").run()
    again = jobs.vault_job(spark, "vault_empresa", load_date="2026-08-02T00:00:00Z").run()
    assert (first["hub_empresa"].appended, first["sat_empresa_dados"].appended) == (2, 3) and (again["hub_empresa"].appended, again["sat_empresa_dados"].appended) == (0, 0)
    with pytest.raises(jobs.JobRefused):
        jobs.vault_job(spark, "vault_empresa", load_date="yesterday")
    build = lambda name: jobs.gold_job(spark, name, load_date="2026-08-03T00:00:00Z").run()
    assert build("gold_company")["dim_company"] == 4 and build("gold_company")["dim_company"] == 0
    store.append(spark.createDataFrame([("0" * 15 + str(i), "2026-07-05T10:00:00.000Z", "2026-07-05T10:00:01.000Z", "00000001", k, "10.00", "BRL", "PIX", "s") for i, k in enumerate(("00000002", "99999999"))], "transaction_id string, event_time string, emitted_at string, payer_cnpj_basico string, payee_cnpj_basico string, amount string, currency string, payment_method string, _record_source string"), "job_payments")
    store.append(spark.createDataFrame([("2026-07-01", "USD", "2026-07-01 13:00:00", "5.0", "5.1")], "quote_date string, currency string, data_hora_cotacao string, cotacao_compra string, cotacao_venda string"), "bronze_ptax")
    keep = spark.table("bronze_payments") if store.table_exists(spark, "bronze_payments") else None
    if keep is not None:
        keep.write.saveAsTable("payments_kept")
        spark.sql("DROP TABLE bronze_payments")
    spark.table("job_payments").write.saveAsTable("bronze_payments")
    conformed = build("gold_conformed")
    assert (conformed["dim_date"], conformed["dim_channel"], conformed["dim_currency"]) == (30, 2, 2)
    fact = build("gold_fact")["fact_payment"]
    assert fact["appended"] == 2 and fact["unresolved"] == {"payer_company_sk": 0, "payee_company_sk": 1} and set(fact["orphans"].values()) == {0}
    with pytest.raises(jobs.JobRefused):
        build("gold_nothing")
    for t in ("hub_empresa", "sat_empresa_dados", "dim_company", "dim_date", "dim_channel", "dim_currency", "fact_payment", "bronze_payments", "bronze_ptax"):
        spark.sql(f"DROP TABLE {t}")


def test_watermarked_stream_keeps_one_row_per_identity(spark, tmp_path):
    spark.createDataFrame([("a", dt.datetime(2027, 1, 1)), ("a", dt.datetime(2027, 1, 1)), ("b", dt.datetime(2027, 1, 1))], "id string, at timestamp").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id string, at timestamp").parquet(str(tmp_path / "in"))
    q = measures.watermarked_dedup(s, "id", "at").writeStream.format("memory").queryName("dedup").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table("dedup").collect()) == ["a", "b"]


# --- measures -----------------------------------------------------------------------------------------------------


def test_lateness_against_the_definition(spark):
    data = [(i, e, m) for i, (e, m) in enumerate([(10, 20), (5, 20), (30, 21), (29, 22), (29, 21), (31, 50), (1, 7200), (40, 7201), (39, 7202), (39, 7201), (40, 9000)])]
    want = [i for i, e, m in data if any(e2 > e for _, e2, m2 in data if m2 < m)]
    df = spark.createDataFrame(data, "i int, e long, m long")
    for width in (1, 10, 3600):
        assert [r[0] for r in rows(measures.late_arrivals(df, "e", "m", width).orderBy("i").select("i"))] == [str(w) and w for w in sorted(want, key=str)]
    assert measures.late_arrivals(df.limit(0), "e", "m").count() == 0


def test_other_measures(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 1, 11), (None, 5, 25), ("b", 9, 10)], "id string, e long, m long")
    assert [r[0] for r in df.select(measures.crosses_window(F.col("e"), F.col("m"), 10)).collect()] == [False, True, True, True]
    assert rows(measures.redelivered(df, "id")) == [("a", 2)] and tuple(measures.duplicate_rows(df.filter("id is not null"), "id").first()) == (3, 2, 1)
    assert tuple(measures.null_drop(df, ["id", "e"]).first()) == (3, 2, 1)
    lines = spark.createDataFrame([('{"a":1,"b":2}',), ('{"b":1}',), ("x",), (None,)], "v string")
    assert rows(measures.undeclared_keys(lines, "v", ["a"])) == [("b", 2)]


# --- generator ----------------------------------------------------------------------------------------------------


def test_a_stream_reproduces_its_bytes_and_its_numbers(spark):
    s = stream(events=300, repeats=40, duplicates=7, late=5, late_by_ms=3_600_000, currencies=("BRL", "USD"), interval_ms=90_000)
    text = [r[0] for r in json_lines(deliveries(spark, s)).collect()]
    assert text == [r[0] for r in json_lines(deliveries(spark, s).repartition(3)).collect()] and len(text) == 307
    records = [json.loads(t) for t in text]
    assert len({r["transaction_id"] for r in records}) == 300 and list(records[0]) == list(COLUMNS["payments"])
    tuples = {tuple(r[c] for c in COLUMNS["payments"][3:]) for r in records}
    assert len(tuples) == 260 and all(r["payer_cnpj_basico"] != r["payee_cnpj_basico"] for r in records)
    ms = lambda t: int(dt.datetime.fromisoformat(t).timestamp() * 1000)
    emitted = [(ms(r["emitted_at"]), ms(r["event_time"])) for r in records]
    assert emitted == sorted(emitted, key=lambda x: x[0])
    late = {r["transaction_id"] for r, (m, e) in zip(records, emitted, strict=True) if any(e2 > e for m2, e2 in emitted if m2 < m)}
    assert len(late) == 5


def test_draws_are_those_of_the_hash(spark):
    s = stream()
    i = spark.range(50).select("id", s.below("amount", 4_999_901, F.col("id")).alias("x"), s.digest("amount", F.col("id")).alias("d")).collect()
    for r in i:
        digest = hash_key_of([s.namespace, "1", "T/amount", str(r.id), "0"])
        assert r.d == digest and r.x == int(digest, 16) % 4_999_901


def test_an_exhausted_pool_is_refused_and_a_small_one_gives_distinct_rows(spark):
    tight = stream(pool=POOL[:2], events=80, repeats=0)
    got = deliveries(spark, tight)
    assert got.select(*COLUMNS["payments"][3:]).distinct().count() == 80


def test_profiles_and_refusals(spark):
    assert all(name == p.name and p.stream(POOL).stream_id == p.stream_id for name, p in PROFILES.items()) and len({p.seed for p in PROFILES.values()}) == len(PROFILES)
    assert PROFILES["messy"].stream(POOL).duplicates == 210
    april = PROFILES["no-snapshot"].stream(POOL)
    refuse_misplaced(april, april.start_ms, april.start_ms + april.events * april.interval_ms)
    for after, before in ((april.start_ms + 1, 1 << 50), (0, april.start_ms + 5)):
        with pytest.raises(StreamRefused):
            refuse_misplaced(april, after, before)
    for over in ({"stream_id": "lower"}, {"repeats": 60}, {"events": 0}, {"pool": POOL[::-1]}, {"currencies": ("USD", "BRL")}, {"late": 1}, {"late": 1, "late_by_ms": 10}, {"undeclared_from": 0}, {"duplicates": 99}):
        with pytest.raises(StreamRefused):
            stream(**over)
    for pool in (["1"], ["00000001"], ["00000001", "00000001"], [" 0000001", "00000002"]):
        with pytest.raises(StreamRefused):
            validated_pool(pool)
    hub = spark.createDataFrame([(k,) for k in POOL], "k string")
    assert generator.pool_of(hub, "k", 5, 7) == generator.pool_of(hub.repartition(3), "k", 5, 7) != generator.pool_of(hub, "k", 5, 8)


# --- landing and extraction ---------------------------------------------------------------------------------------


def test_files_are_emitted_once(tmp_path):
    path = tmp_path / "d" / "f.jsonl"
    assert landing.emit_file(["a", "é"], path).written and path.read_bytes() == "a\né\n".encode()
    assert not landing.emit_file(["a", "é"], path).written
    with pytest.raises(LandingRefused):
        landing.emit_file(["b"], path)
    with pytest.raises(LandingRefused):
        landing.emit_file(["a\nb"], tmp_path / "g")
    assert [p.name for p in tmp_path.rglob("*.part")] == [] and path.read_text() == "a\né\n"
    assert landing.copy_verified(path, tmp_path / "c" / "f") == path.stat().st_size
    with pytest.raises(LandingRefused):
        landing.safe_name("../x")


def test_archives(tmp_path):
    def archive(name, *members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m in members:
                z.writestr(m, "content")
        return tmp_path / name

    got = landing.unzip_single(archive("one.zip", "dir/inner.csv"), tmp_path)
    stamp = got.stat().st_mtime_ns
    assert got.name == "inner.csv" and landing.unzip_single(tmp_path / "one.zip", tmp_path).stat().st_mtime_ns == stamp
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    for bad in (archive("two.zip", "a", "b"), archive("none.zip"), tmp_path / "bad.zip"):
        with pytest.raises(LandingRefused):
            landing.unzip_single(bad, tmp_path)
    assert landing.missing_files(["Empresas0.zip"], ["empresas"]) == [f"Empresas{i}.zip" for i in range(1, 10)]
    with pytest.raises(LandingRefused):
        landing.expected_files(["nothing"])


def test_downloads_resume_and_must_be_whole(tmp_path):
    content, log = b"0123456789", []

    def server(plan, shift=0):
        steps = iter(plan)

        def send(method, url, headers):
            log.append(headers.get("Range"))
            step = next(steps)
            if isinstance(step, int):
                return Response(step, {}, [])
            start = int(headers["Range"][6:-1]) if "Range" in headers else 0
            if step == "whole":
                return Response(200, {}, [content])

            def body():
                yield content[start : start + step[0]]
                if step[1]:
                    raise OSError("broken")

            return Response(206 if start else 200, {"content-range": f"bytes {start - shift}-9/10"} if start else {}, body())

        return WebDav("http://x", send, pause=lambda s: None)

    assert server([503, (4, True), (3, True), (9, False)]).download("f", tmp_path / "f", 10).read_bytes() == content
    assert log == [None, None, "bytes=4-", "bytes=7-"]
    assert server([(4, True), "whole", "whole"]).download("f", tmp_path / "g", 10).read_bytes() == content
    with pytest.raises(ExtractionRefused):  # a partial answer that begins elsewhere must not be appended
        server([(4, True), (6, False)], shift=1).download("f", tmp_path / "i", 10)
    assert (tmp_path / "i.part").read_bytes() == content[:4]
    for plan in ([404], [500] * 5, [(2, False), (0, False)] + [(0, False)] * 20):
        with pytest.raises(ExtractionRefused):
            server(plan).download("f", tmp_path / "h", 10)
    listing = b'<d:multistatus xmlns:d="DAV:"><d:response><d:href>/p/b.zip</d:href><d:propstat><d:prop><d:getcontentlength>5</d:getcontentlength></d:prop></d:propstat></d:response><d:response><d:href>/p/</d:href></d:response></d:multistatus>'
    assert WebDav("http://x", lambda *a: Response(207, {}, [listing])).list_dir("p") == [Remote("b.zip", 5)]


def test_parts_are_all_there_or_none_is_fetched(tmp_path):
    listing = b'<d:multistatus xmlns:d="DAV:"><d:response><d:href>/p/a.zip</d:href><d:propstat><d:prop><d:getcontentlength>3</d:getcontentlength></d:prop></d:propstat></d:response></d:multistatus>'
    dav = WebDav("http://x", lambda method, url, headers: Response(207, {}, [listing]) if method == "PROPFIND" else Response(200, {}, [b"abc"]))
    assert [p.read_bytes() for p in extraction.download_parts(dav, "p", ["a.zip"], tmp_path)] == [b"abc"]
    with pytest.raises(ExtractionRefused):
        extraction.download_parts(dav, "p", ["a.zip", "b.zip"], tmp_path)


def test_quotes():
    day = dt.date(2026, 6, 1)
    body = lambda *q: json.dumps({"value": [{"cotacaoCompra": c, "cotacaoVenda": v, "dataHoraCotacao": t} for c, v, t in q]})
    one = (5.05, 5.1, "2026-06-01 13:00:00.5")
    assert extraction.fetch_series(lambda d, c: body(one) if d == day else body(), day, day + dt.timedelta(days=2), "USD") == [extraction.Quote("2026-06-01", "USD", "2026-06-01 13:00:00.5", "5.05", "5.1")]
    assert extraction.sole_quote(extraction.quotes_in(body((5.05, 5.1, "2026-06-01 13:00:30"), one), day, "USD")).data_hora_cotacao.endswith(".5")
    for bad in ([(5.05, -1, one[2])], [(5.05, "NaN", one[2])], [(5.05, 5.1, "2026-05-31 13:00:00")], [one, (5.05, 5.2, one[2])], [one, (5.05, 5.1, "2026-06-01 13:02:00")]):
        with pytest.raises(ExtractionRefused):
            extraction.sole_quote(extraction.quotes_in(body(*bad), day, "USD"))
    with pytest.raises(ExtractionRefused):
        extraction.fetch_series(lambda d, c: body(), day, day, "USD")


def test_database_snapshot():
    class Cursor(list):
        def fetchone(self):
            return self[0]

        def fetchall(self):
            return list(self)

    class Connection:
        def __init__(self, columns, n):
            self.said, self.columns, self.n = [], columns, n

        def execute(self, sql):
            self.said.append(sql)
            if "information_schema" in sql:
                return Cursor([(c,) for c in self.columns])
            if "count(*)" in sql:
                return Cursor([(self.n,)])
            if "::text" in sql and "max(" not in sql:
                return Cursor([("1", "a"), ("2", "b")])
            return Cursor([("2026-06-01T00:00:00.000000Z",)])

    c = Connection(["id", "name"], 2)
    assert extraction.consistent_snapshot(c, "s.t", ["id", "name"], "id", "updated_at").rows == [("1", "a"), ("2", "b")] and c.said[-1] == "COMMIT" and any("REPEATABLE READ READ ONLY" in s for s in c.said)
    for bad in (Connection(["id"], 2), Connection(["id", "name"], 3)):
        with pytest.raises(ExtractionRefused):
            extraction.consistent_snapshot(bad, "s.t", ["id", "name"], "id", "updated_at")
        assert bad.said[-1] == "COMMIT"
    assert extraction.changed_since(Connection([], 0), "s.t", "id", "updated_at", "x") == ["1", "2"]


def test_files_already_landed_are_left_out(spark, monkeypatch):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "_source_file string, v int")
    staged = spark.createDataFrame([("a",)] * 50 + [("z",)], "_source_file string")
    for sent in (ingest.SENT_FILES, 0):
        monkeypatch.setattr(ingest, "SENT_FILES", sent)
        assert rows(ingest.unlanded(batch, staged).select("_source_file", "v")) == [(None, 4), ("b", 3)]
    assert ingest.unlanded(batch, staged.filter("_source_file = 'z'")).count() == 4 and ingest.unlanded(batch, staged.limit(0)).count() == 4


def test_snapshot_records_are_stamped():
    taken = extraction.Snapshot("2026-08-01T00:00:00.000000Z", [("1", "a")], "w", "10:20:", "0/16B3748")
    assert taken.records(["id", "name"]) == [{"id": "1", "name": "a", "_snapshot_at": taken.taken_at, "_pg_snapshot": "10:20:", "_pg_wal_lsn": "0/16B3748"}]


def test_command_line_and_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tidemark.__main__ import parser
    from tidemark.session import NoSharedFolder, shared_folder

    a = parser().parse_args(["vault", "--job", "vault_empresa", "--load-date", "2026-08-01T00:00:00Z", "--months", "2026-06"])
    assert (a.kind, a.job, a.months) == ("vault", "vault_empresa", "2026-06")
    with pytest.raises(SystemExit):
        parser().parse_args(["gold"])
    monkeypatch.delenv("TIDEMARK_SHARED", raising=False)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(NoSharedFolder):
        shared_folder(cluster)
