"""The ledger jobs (D1-D8) as functions of ``spark`` and a config.

Each ``compute_*`` function is pure (DataFrames in, DataFrames out) and each
``run_*`` function reads, computes, writes and returns its counts. Nothing
runs at import. ``run_all`` runs the jobs as their dependencies allow:

    postal codes ─► quarantine ─► suppliers ─┬─► invoices ─► schedule
    payment terms ───────────────────────────┘
    address types ───────────────────────────┬─► supplier addresses
                                (suppliers) ─┘
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import canonicalize, cast_columns, fill_null, trim_strings, try_int, upper_trim
from ledgerflow.operators import (
    Lookup,
    Validation,
    extract_entity,
    installment_schedule,
    invalid_installment_counts,
    refresh_status,
    resolve_keys,
    rule_check_digit,
    rule_duplicated,
    rule_expr,
    rule_in_domain,
    rule_in_lookup,
    rule_not_null,
    schedule_with_pending,
    validate,
)
from ledgerflow.plans.claims import exists
from ledgerflow.plans.graph import Step, run_steps
from ledgerflow.plans.history import RunHistory
from ledgerflow.plans.increment import refresh_schedule
from ledgerflow.plans.publish import Publication
from ledgerflow.plans.seen import SeenRows
from ledgerflow.plans.tables import JdbcTables, LakeTables, pending_rows
from ledgerflow.session import sized_shuffle, small_tasks
from ledgerflow.sources import read_csv, read_csv_checked, string_schema, typed_schema, write_csv
from ledgerflow.sources.files import LINE, ORIGIN, malformed_lines

LOG = logging.getLogger("ledgerflow")

# Fixed values of the purchases feed: its 17 columns in file order.
PURCHASE_COLUMNS = [
    "NOME_FORNECEDOR", "CNPJ_FORNECEDOR", "EMAIL_FORNECEDOR", "TELEFONE_FORNECEDOR", "NUMERO_NF", "DATA_EMISSAO",
    "VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL", "NOME_ITEM", "QTD_ITEM", "CONDICAO_PAGAMENTO", "CEP", "NUM_ENDERECO",
    "COMPLEMENTO", "TIPO_ENDERECO", "DATA_PROCESSAMENTO",
]

# Accepted payment-term spellings (after upper/trim) and their
# canonical names. "ENTRADA/30/60/90 DIAS" is folded into "30/60/90 DIAS".
TERM_ALIASES = {
    "ENTRADA/30/60/90 DIAS": "30/60/90 DIAS",
    "A VISTA": "A VISTA",
    "30 DIAS": "30 DIAS",
    "30/60 DIAS": "30/60 DIAS",
    "ENTRADA/30 DIAS": "ENTRADA/30 DIAS",
    "ENTRADA/30/60 DIAS": "ENTRADA/30/60 DIAS",
}

# Reason labels in the order they are reported, and the
# payment-status labels.
LABEL_DUPLICATED = "duplicated"
LABEL_NULL = "null column(s)"
LABEL_TERM = "invalid payment condition"
LABEL_CNPJ = "invalid CNPJ"
LABEL_CEP = "invalid CEP"
LABEL_MALFORMED = "malformed line"
STATUS_PAID = "PAGO"
STATUS_PENDING = "PENDENTE"


@dataclass
class JobConfig:
    source_path: str                       # input CSV folder
    target_path: str                       # staging / rejected / lake tables
    # fixed values: the input file names of the ledger feed
    purchases_file: str = "compras.csv"
    terms_file: str = "condicao_pagamento.csv"
    address_types_file: str = "tipo_endereco.csv"
    postal_codes_file: str = "postal_codes.csv"  # a name of this library's own
    term_aliases: Mapping[str, str] = field(default_factory=lambda: dict(TERM_ALIASES))
    as_of: date | str | None = None        # payment status reference day; None = today
    jdbc: object | None = None             # JdbcConfig → tables in a database
    jdbc_upsert_method: str = "merge"      # or "update_insert"
    # what becomes of source rows that share a business key: "raise" stops the
    # job, "latest" keeps the row with the largest ``order_by`` values
    on_duplicate: str = "raise"
    order_by: Mapping[str, list[str]] = field(default_factory=dict)  # per table; default: all its columns
    keep_versions: int | None = None       # lake tables: versions that stay; None = all
    load: str | None = None                # name of this load of purchases: duplicates are found across loads
    buckets: int | None = None             # lake tables: rewrite by bucket of the key; None = whole tables

    def src(self, name: str) -> str:
        return f"{self.source_path.rstrip('/')}/{name}"

    def out(self, name: str) -> str:
        return f"{self.target_path.rstrip('/')}/{name}"


def tables_for(spark: SparkSession, cfg: JobConfig):
    if cfg.jdbc is not None:
        return JdbcTables(spark, cfg.jdbc, cfg.jdbc_upsert_method)
    return LakeTables(spark, cfg.out("tables"), cfg.keep_versions, cfg.buckets)


def _upsert(spark, cfg: JobConfig, name: str, df: DataFrame) -> dict[str, int]:
    order = cfg.order_by.get(name) or df.columns
    return tables_for(spark, cfg).upsert(name, df, on_duplicate=cfg.on_duplicate, order_by=order)


# ---------------------------------------------------------------- dimensions


def compute_postal_codes(spark: SparkSession, path: str) -> DataFrame:
    """Postal codes: headerless ``;`` file, typed schema, text upper/trimmed."""
    schema = typed_schema({"CEP": "int", "UF": "string", "CIDADE": "string", "BAIRRO": "string", "LOGRADOURO": "string"})
    df = read_csv(spark, path, header=False, sep=";", schema=schema)
    return df.select("CEP", *[upper_trim(c).alias(c) for c in ("UF", "CIDADE", "BAIRRO", "LOGRADOURO")])


def compute_payment_terms(spark: SparkSession, path: str) -> DataFrame:
    """Payment terms: header CSV (BOM tolerated), 3 of 4 columns, typed (D3)."""
    df = read_csv(spark, path, header=True, sep=",")
    return df.select(
        try_int("ID_CONDICAO").alias("ID_CONDICAO"),
        upper_trim("DESCRICAO").alias("DESCRICAO"),
        try_int("QTD_PARCELAS").alias("QTD_PARCELAS"),
    )


def compute_address_types(spark: SparkSession, path: str) -> DataFrame:
    """Address types: upper/trim, renamed to the table's columns."""
    df = read_csv(spark, path, header=True, sep=",")
    return df.select(
        try_int("id_tipo_endereco").alias("ID_TIPO_ENDERECO"),
        upper_trim("nome_tipo_endereco").alias("DESCRICAO"),
        upper_trim("sigla_endereco").alias("SIGLA"),
    )


# ---------------------------------------------------------------- quarantine


def clean_purchases(df: DataFrame, term_aliases: Mapping[str, str]) -> DataFrame:
    """Trim all, upper names and terms, canonical terms, COMPLEMENTO NULL → 'N/A'.
    The columns of a checked read's malformed lines stay as they are."""
    df = trim_strings(df, [c for c in df.columns if c not in ORIGIN], upper=["NOME_FORNECEDOR", "CONDICAO_PAGAMENTO"])
    df = df.withColumn("CONDICAO_PAGAMENTO", canonicalize("CONDICAO_PAGAMENTO", term_aliases))
    return fill_null(df, "N/A", ["COMPLEMENTO"])


def purchase_rules(postal_codes: DataFrame, term_aliases: Mapping[str, str]):
    return [
        rule_duplicated(LABEL_DUPLICATED),
        rule_not_null(label=LABEL_NULL, exclude=["COMPLEMENTO"]),
        rule_in_domain("CONDICAO_PAGAMENTO", sorted(set(term_aliases.values())), LABEL_TERM),
        rule_check_digit("CNPJ_FORNECEDOR", LABEL_CNPJ),
        rule_in_lookup(lambda df: try_int("CEP"), postal_codes, "CEP", LABEL_CEP),
    ]


def compute_purchases_quarantine(purchases: DataFrame, postal_codes: DataFrame, term_aliases: Mapping[str, str] = TERM_ALIASES, seen=None, load: str | None = None) -> Validation:
    """Split purchases into accepted staging rows and rejected rows with reasons.

    Malformed lines of a checked read (its ``ORIGIN`` columns) are blocked in
    the same pass; ``malformed_purchases`` lists them. ``seen`` and ``load``:
    duplicates across loads (see ``validate``).
    """
    carry = [c for c in ORIGIN if c in purchases.columns]
    cleaned = clean_purchases(purchases, term_aliases)
    rules = purchase_rules(postal_codes, term_aliases)
    if carry:
        rules = [*rules, rule_expr(F.col(LINE).isNotNull(), LABEL_MALFORMED)]
    return validate(cleaned, rules, columns=PURCHASE_COLUMNS, carry=carry, seen=seen, load=load)


def malformed_purchases(v: Validation) -> DataFrame:
    """(line, file, block, reason) of the malformed lines of a validation."""
    return malformed_lines(v.annotated, string_schema(PURCHASE_COLUMNS), {"sep": ","})


def read_purchases(spark: SparkSession, path: str) -> DataFrame:
    """The purchases feed as 17 string columns, and the ``ORIGIN`` columns of
    malformed lines. The header must name the columns (``enforceSchema=false``:
    a renamed or reordered column fails the read instead of shifting values
    into the wrong column)."""
    return read_csv_checked(spark, path, string_schema(PURCHASE_COLUMNS), header=True, sep=",", enforceSchema="false").all_rows


# ---------------------------------------------------------------- entities


def compute_suppliers(staging: DataFrame) -> DataFrame:
    """Distinct suppliers of the accepted purchases."""
    return extract_entity(
        staging,
        ["NOME_FORNECEDOR", "CNPJ_FORNECEDOR", "EMAIL_FORNECEDOR", "TELEFONE_FORNECEDOR"],
        {"NOME_FORNECEDOR": "NOME", "CNPJ_FORNECEDOR": "CNPJ", "EMAIL_FORNECEDOR": "EMAIL", "TELEFONE_FORNECEDOR": "TELEFONE"},
    )


def compute_supplier_addresses(staging: DataFrame, suppliers: DataFrame, address_types: DataFrame, observe=None) -> DataFrame:
    """Supplier addresses with resolved supplier and address-type ids."""
    df = staging.select("CNPJ_FORNECEDOR", "TIPO_ENDERECO", "NUM_ENDERECO", "COMPLEMENTO", "CEP").distinct()
    df = resolve_keys(df, [
        Lookup(suppliers, "CNPJ_FORNECEDOR", "CNPJ", take={"ID_FORNECEDOR": "ID_FORNECEDOR"}),
        Lookup(address_types, "TIPO_ENDERECO", "DESCRICAO", take={"ID_TIPO_ENDERECO": "ID_TIPO_ENDERECO"}, casefold=True),
    ], observe=observe)
    df = df.select(try_int("CEP").alias("CEP"), "ID_FORNECEDOR", "ID_TIPO_ENDERECO", "NUM_ENDERECO", "COMPLEMENTO")
    return df


def compute_invoices(staging: DataFrame, suppliers: DataFrame, terms: DataFrame, observe=None) -> DataFrame:
    """Incoming invoices with supplier id (inner) and term id (left), typed."""
    df = staging.select(
        "NUMERO_NF", "DATA_EMISSAO", "VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL", "NOME_ITEM", "QTD_ITEM",
        "CONDICAO_PAGAMENTO", "CNPJ_FORNECEDOR",
    )
    df = resolve_keys(df, [
        Lookup(suppliers, "CNPJ_FORNECEDOR", "CNPJ", take={"ID_FORNECEDOR": "ID_FORNECEDOR"}),
        Lookup(terms, "CONDICAO_PAGAMENTO", "DESCRICAO", take={"ID_CONDICAO": "ID_CONDICAO"}, how="left"),
    ], observe=observe)
    df = df.select("NUMERO_NF", "ID_FORNECEDOR", "ID_CONDICAO", "DATA_EMISSAO", "VALOR_NET", "VALOR_TRIBUTO", "VALOR_TOTAL", "NOME_ITEM", "QTD_ITEM")
    return cast_columns(df, {
        "DATA_EMISSAO": "date", "VALOR_NET": "decimal(10,2)", "VALOR_TRIBUTO": "decimal(10,2)",
        "VALOR_TOTAL": "decimal(10,2)", "QTD_ITEM": "int",
    })


def unscheduled_invoices(invoices: DataFrame, count_col: str = "QTD_PARCELAS") -> DataFrame:
    """Invoices that get no schedule: their payment term is unknown or gives
    no installments."""
    return invalid_installment_counts(invoices, count_col)


def compute_schedule(invoices: DataFrame, pending: DataFrame | None, as_of=None, **schedule_kw) -> DataFrame:
    """Installment schedule of the invoices plus still-pending rows, with status.

    ``invoices`` needs ID_NF_ENTRADA, DATA_EMISSAO, VALOR_TOTAL and the
    QTD_PARCELAS of their payment term (``unscheduled_invoices`` lists those
    that get no row).
    """
    sched = installment_schedule(
        invoices, id_col="ID_NF_ENTRADA", issue_date_col="DATA_EMISSAO", total_col="VALOR_TOTAL", count_col="QTD_PARCELAS",
        due_col="DATA_VENCIMENTO", number_col="NUM_PARCELA", amount_col="VALOR_PARCELA", **schedule_kw,
    )
    if pending is not None:
        sched = schedule_with_pending(sched, pending.select(*sched.columns), ["ID_NF_ENTRADA", "NUM_PARCELA"])
    return refresh_status(sched, "DATA_VENCIMENTO", "STATUS_PAGAMENTO", as_of=as_of, paid=STATUS_PAID, pending=STATUS_PENDING)


# ---------------------------------------------------------------- runners


def _log(job: str, stats: Mapping[str, int]) -> dict[str, int]:
    LOG.info("%s: %s", job, ", ".join(f"{k}={v}" for k, v in stats.items()))
    return dict(stats)


def run_postal_codes(spark, cfg: JobConfig):
    return _log("CEP", _upsert(spark, cfg, "CEP", compute_postal_codes(spark, cfg.src(cfg.postal_codes_file))))


def run_payment_terms(spark, cfg: JobConfig):
    return _log("CONDICAO_PAGAMENTO", _upsert(spark, cfg, "CONDICAO_PAGAMENTO", compute_payment_terms(spark, cfg.src(cfg.terms_file))))


def run_address_types(spark, cfg: JobConfig):
    return _log("TIPO_ENDERECO", _upsert(spark, cfg, "TIPO_ENDERECO", compute_address_types(spark, cfg.src(cfg.address_types_file))))


#: How a judged row is filed: "both" is a good row that is reported as a
#: duplicate too, "seen" one that an earlier load delivered and reported.
ACCEPTED, REJECTED, BOTH, MALFORMED, SEEN = "accepted", "rejected", "both", "malformed", "seen"


def with_verdict(v: Validation) -> DataFrame:
    """The annotated rows with their ``verdict``."""
    ok, bad = v.is_accepted, v.is_rejected
    verdict = F.when(ok & bad, BOTH).when(ok, ACCEPTED).when(bad, REJECTED).otherwise(SEEN)
    if LINE in v.annotated.columns:
        verdict = F.when(F.col(LINE).isNotNull(), MALFORMED).otherwise(verdict)
    return v.annotated.withColumn("verdict", verdict)


def publish_quarantine(v: Validation, folder: str) -> dict[str, int]:
    """Write a judged load below ``folder``: all rows once, as Parquet by
    verdict (``rows/``; staging reads two of these parts), and from that copy
    the rejected rows and the malformed lines as ``;`` CSV. Returns the counts,
    observed during the first write."""
    spark = v.annotated.sparkSession
    obs = Observation("verdicts")
    rows = with_verdict(v)
    rows = rows.observe(obs, *[F.count_if(F.col("verdict") == k).alias(k) for k in (ACCEPTED, REJECTED, BOTH, MALFORMED)])
    # the grouping, and the sort by verdict behind it, hold a task's rows in memory
    with small_tasks(spark, v.annotated):
        rows.write.partitionBy("verdict").parquet(f"{folder}/rows")
    back = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    write_csv(back.where(F.col("verdict").isin(REJECTED, BOTH)).select(*v.columns, v.reasons_col), f"{folder}/rejected", sep=";", header=True)
    n = obs.get
    if n[MALFORMED]:
        lines = malformed_lines(back.where(F.col("verdict") == MALFORMED), string_schema(v.columns), {"sep": ","})
        # a line with quotes, separators or blanks at its ends must come back as it was
        write_csv(lines, f"{folder}/malformed", sep=";", header=True, quoteAll="true", escape='"')
    return {"written": n[ACCEPTED] + n[BOTH], "rejected": n[REJECTED] + n[BOTH], **({"malformed": n[MALFORMED]} if n[MALFORMED] else {})}


def purchases_publication(spark, cfg: JobConfig) -> Publication:
    return Publication(spark, cfg.out("purchases"))


def run_quarantine(spark, cfg: JobConfig):
    """Judge the purchases file and publish accepted and rejected rows and
    malformed lines together. With ``cfg.load``, rows of earlier loads count
    as copies."""
    postal = tables_for(spark, cfg).read("CEP")
    purchases = read_purchases(spark, cfg.src(cfg.purchases_file))
    seen = SeenRows(spark, cfg.out("purchases-seen"), PURCHASE_COLUMNS) if cfg.load else None
    # the grouping shuffles the whole input: size its partitions for it
    with sized_shuffle(spark, purchases), purchases_publication(spark, cfg).new_run(cfg.keep_versions) as folder:
        v = compute_purchases_quarantine(purchases, postal, cfg.term_aliases, seen=seen, load=cfg.load)
        stats = publish_quarantine(v, folder)
    if seen is not None:
        v.record()
    return _log("quarantine", stats)


def read_staging(spark, cfg: JobConfig) -> DataFrame:
    """The accepted purchases of the newest published run."""
    folder = purchases_publication(spark, cfg).newest()
    if folder is None:
        raise FileNotFoundError(f"no purchases are published under {cfg.out('purchases')}")
    return read_published(spark, folder, string_schema(PURCHASE_COLUMNS))


def read_published(spark, folder: str, schema) -> DataFrame:
    """The accepted rows of a published run."""
    parts = [f"{folder}/rows/verdict={k}" for k in (ACCEPTED, BOTH) if exists(spark, f"{folder}/rows/verdict={k}")]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def run_suppliers(spark, cfg: JobConfig):
    return _log("FORNECEDORES", _upsert(spark, cfg, "FORNECEDORES", compute_suppliers(read_staging(spark, cfg))))


def run_supplier_addresses(spark, cfg: JobConfig):
    """Rows whose supplier or address type is unknown are not loaded (inner
    lookups); their counts come back as ``unmatched_*``, observed while the
    rows are computed."""
    t = tables_for(spark, cfg)
    obs = Observation("addresses-unmatched")
    df = compute_supplier_addresses(read_staging(spark, cfg), t.read("FORNECEDORES"), t.read("TIPO_ENDERECO"), observe=obs)
    stats = _upsert(spark, cfg, "ENDERECOS_FORNECEDORES", df)
    got = obs.get
    stats.update(unmatched_supplier=int(got.get("unmatched_0", 0)), unmatched_address_type=int(got.get("unmatched_1", 0)))
    return _log("ENDERECOS_FORNECEDORES", stats)


def run_invoices(spark, cfg: JobConfig):
    """Invoices of unknown suppliers are not loaded; ``unmatched_supplier``
    counts them. An unknown payment term loads with a NULL term id."""
    t = tables_for(spark, cfg)
    obs = Observation("invoices-unmatched")
    df = compute_invoices(read_staging(spark, cfg), t.read("FORNECEDORES"), t.read("CONDICAO_PAGAMENTO"), observe=obs)
    stats = _upsert(spark, cfg, "NOTAS_FISCAIS_ENTRADA", df)
    stats.update(unmatched_supplier=int(obs.get.get("unmatched_0", 0)))
    return _log("NOTAS_FISCAIS_ENTRADA", stats)


def run_schedule(spark, cfg: JobConfig):
    """``unscheduled`` counts the invoices without any installment, among them
    ``unmatched_term`` of no known payment term; left out when zero."""
    t = tables_for(spark, cfg)
    if isinstance(t, LakeTables) and t.buckets:
        return _log("PROGRAMACAO_PAGAMENTO", _refresh_schedule(t, cfg))
    cols = ["ID_NF_ENTRADA", "DATA_VENCIMENTO", "NUM_PARCELA", "VALOR_PARCELA"]
    pending = pending_rows(t.read("PROGRAMACAO_PAGAMENTO"), STATUS_PENDING, cols)
    invoices = t.invoices_with_counts()
    stats = _upsert(spark, cfg, "PROGRAMACAO_PAGAMENTO", compute_schedule(invoices, pending, as_of=cfg.as_of))
    stats.update(_unscheduled(invoices))
    return _log("PROGRAMACAO_PAGAMENTO", stats)


def _unscheduled(invoices: DataFrame) -> dict[str, int]:
    lost = unscheduled_invoices(invoices).agg(F.count(F.lit(1)).alias("unscheduled"), F.count_if(F.col("QTD_PARCELAS").isNull()).alias("unmatched_term")).first()
    return {k: int(v) for k, v in lost.asDict().items() if v}


def _refresh_schedule(t: LakeTables, cfg: JobConfig) -> dict[str, int]:
    """The schedule of changed invoices and of installments that came due."""
    def compute(invoices: DataFrame) -> DataFrame:
        return compute_schedule(t.invoices_with_counts(invoices), None, as_of=cfg.as_of)

    stats = refresh_schedule(
        t.bucketed("NOTAS_FISCAIS_ENTRADA"), t.bucketed("CONDICAO_PAGAMENTO"), t.bucketed("PROGRAMACAO_PAGAMENTO"), compute,
        id_col="ID_NF_ENTRADA", term_col="ID_CONDICAO", due_col="DATA_VENCIMENTO", status_col="STATUS_PAGAMENTO",
        paid=STATUS_PAID, pending=STATUS_PENDING, as_of=cfg.as_of,
    )
    return {"INSERT": stats["INSERT"], "UPDATE": stats["UPDATE"], **_unscheduled(t.invoices_with_counts())}


def steps(cfg: JobConfig) -> list[Step]:
    """The eight jobs and what each of them reads from."""
    return [
        Step("CEP", lambda s: run_postal_codes(s, cfg)),
        Step("CONDICAO_PAGAMENTO", lambda s: run_payment_terms(s, cfg)),
        Step("TIPO_ENDERECO", lambda s: run_address_types(s, cfg)),
        Step("quarantine", lambda s: run_quarantine(s, cfg), ["CEP"]),
        Step("FORNECEDORES", lambda s: run_suppliers(s, cfg), ["quarantine"]),
        Step("ENDERECOS_FORNECEDORES", lambda s: run_supplier_addresses(s, cfg), ["CEP", "FORNECEDORES", "TIPO_ENDERECO"]),
        Step("NOTAS_FISCAIS_ENTRADA", lambda s: run_invoices(s, cfg), ["FORNECEDORES", "CONDICAO_PAGAMENTO"]),
        Step("PROGRAMACAO_PAGAMENTO", lambda s: run_schedule(s, cfg), ["NOTAS_FISCAIS_ENTRADA"]),
    ]


def run_history(spark, cfg: JobConfig) -> RunHistory:
    return RunHistory(spark, cfg.out("history"))


def run_all(spark, cfg: JobConfig, run: str | None = None, parallel: int = 4) -> dict[str, dict[str, int]]:
    """All jobs, those that do not wait for each other side by side; returns
    the counts of each. Under the name ``run`` they are kept in the history,
    and a run of that name that stopped goes on after its finished steps."""
    history = run_history(spark, cfg) if run else None
    return run_steps(spark, steps(cfg), history=history, run=run, parallel=parallel)
