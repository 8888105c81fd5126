from ledgerflow.sources import jdbc_config_from_env, read_csv, read_parquet, typed_schema, write_csv, write_parquet


def test_jdbc_config_from_env_hides_password():
    cfg = jdbc_config_from_env(environ={"LEDGERFLOW_DB_URL": "jdbc:x://h/db", "LEDGERFLOW_DB_USER": "u",
                                        "LEDGERFLOW_DB_PASSWORD": "secret", "LEDGERFLOW_DB_DRIVER": "d"})
    assert cfg.options() == {"url": "jdbc:x://h/db", "driver": "d", "user": "u", "password": "secret"}
    assert "secret" not in repr(cfg)


def test_csv_with_bom_header_all_strings(spark, tmp_path):
    p = tmp_path / "terms.csv"
    p.write_text("\ufeffID,NAME,N\r\n1, a ,2\r\n2,,3", encoding="utf-8")
    df = read_csv(spark, str(p), header=True)
    assert df.columns == ["ID", "NAME", "N"]
    assert dict(df.dtypes) == {"ID": "string", "NAME": "string", "N": "string"}
    rows = df.orderBy("ID").collect()
    assert (rows[0].NAME, rows[1].NAME) == (" a ", None)  # empty field → NULL


def test_headerless_typed_csv_malformed_becomes_null(spark, tmp_path):
    p = tmp_path / "cep.csv"
    p.write_text("12605010;sp\nabc;rj\n", encoding="utf-8")
    df = read_csv(spark, str(p), header=False, sep=";", schema=typed_schema({"CEP": "int", "UF": "string"}))
    assert [tuple(r) for r in df.collect()] == [(12605010, "sp"), (None, "rj")]


def test_writers_observe_counts(spark, tmp_path):
    df = spark.range(0, 100).selectExpr("id", "cast(id as string) as s")
    obs = write_parquet(df, str(tmp_path / "p"), observe="p")
    assert obs.get["rows"] == 100
    obs = write_csv(df, str(tmp_path / "c"), observe="c")
    assert obs.get["rows"] == 100
    assert read_parquet(spark, str(tmp_path / "p"), ["s"]).count() == 100
