"""Target tables (db DDL re-aimed) and where they live.

``LakeTables`` keeps each table as versioned Parquet folders
``<root>/<TABLE>/v<NNNNNN>``. An upsert reads the newest complete version
(one with ``_SUCCESS``), merges, and writes the next version; the version it
read is never overwritten, so a failed write leaves the table as it was and
readers never see a half-written version.

With ``buckets=n`` a table lies in ``plans.buckets.BucketTable`` instead: an
upsert then reads and rewrites only the buckets that its source touches.

Either way one writer at a time holds the claim of a table's next version (and
of the ids that go with it); another one stops with ``ConcurrentWriteError``.

``JdbcTables`` reads whole tables with JDBC and upserts with a staged MERGE
run by the database (identity columns are then filled by the database).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.joins import lookup_join
from ledgerflow.operators.upsert import merge_observation, upsert_snapshot
from ledgerflow.plans import claims
from ledgerflow.plans.buckets import BucketTable
from ledgerflow.session import sized_shuffle
from ledgerflow.sources import jdbc as J
from ledgerflow.sources.sinks import write_parquet


def _s(n: int | None = None) -> T.DataType:
    """Text of any length, or of at most ``n`` characters."""
    return T.StringType() if n is None else T.VarcharType(n)


#: How the tables' text columns compare: without regard to case and trailing
#: blanks, but with accents (SQL Server's Latin1_General_CP1_CI_AS).
DDL_COLLATION = "UNICODE_CI_RTRIM"

# The seven target tables of the ledger, their columns, types,
# business keys, identity columns, columns that must be set and foreign keys.
TABLES: dict[str, dict] = {
    "CEP": {
        "schema": [("CEP", T.IntegerType()), ("UF", _s()), ("CIDADE", _s()), ("BAIRRO", _s()), ("LOGRADOURO", _s())],
        "keys": ["CEP"], "identity": None, "not_null": ["CEP"],
    },
    "CONDICAO_PAGAMENTO": {
        "schema": [("ID_CONDICAO", T.IntegerType()), ("DESCRICAO", _s(255)), ("QTD_PARCELAS", T.IntegerType())],
        "keys": ["ID_CONDICAO"], "identity": None, "not_null": ["ID_CONDICAO"],
    },
    "TIPO_ENDERECO": {
        "schema": [("ID_TIPO_ENDERECO", T.IntegerType()), ("DESCRICAO", _s(255)), ("SIGLA", _s(50))],
        "keys": ["ID_TIPO_ENDERECO"], "identity": None, "not_null": ["ID_TIPO_ENDERECO"],
    },
    "FORNECEDORES": {
        "schema": [("ID_FORNECEDOR", T.LongType()), ("NOME", _s(255)), ("CNPJ", _s(20)), ("EMAIL", _s(255)), ("TELEFONE", _s(20))],
        "keys": ["CNPJ"], "identity": "ID_FORNECEDOR",
    },
    "ENDERECOS_FORNECEDORES": {
        "schema": [("ID_ENDERECO_FORNECEDOR", T.LongType()), ("CEP", T.IntegerType()), ("ID_FORNECEDOR", T.LongType()),
                   ("ID_TIPO_ENDERECO", T.IntegerType()), ("NUM_ENDERECO", _s(50)), ("COMPLEMENTO", _s(255))],
        "keys": ["CEP", "ID_FORNECEDOR", "ID_TIPO_ENDERECO"], "identity": "ID_ENDERECO_FORNECEDOR",
        "references": {"CEP": ("CEP", "CEP"), "ID_FORNECEDOR": ("FORNECEDORES", "ID_FORNECEDOR"), "ID_TIPO_ENDERECO": ("TIPO_ENDERECO", "ID_TIPO_ENDERECO")},
    },
    "NOTAS_FISCAIS_ENTRADA": {
        "schema": [("ID_NF_ENTRADA", T.LongType()), ("NUMERO_NF", _s(255)), ("ID_FORNECEDOR", T.LongType()),
                   ("ID_CONDICAO", T.IntegerType()), ("DATA_EMISSAO", T.DateType()), ("VALOR_NET", T.DecimalType(10, 2)),
                   ("VALOR_TRIBUTO", T.DecimalType(10, 2)), ("VALOR_TOTAL", T.DecimalType(10, 2)), ("NOME_ITEM", _s(255)),
                   ("QTD_ITEM", T.IntegerType())],
        "keys": ["NUMERO_NF"], "identity": "ID_NF_ENTRADA",
        "references": {"ID_FORNECEDOR": ("FORNECEDORES", "ID_FORNECEDOR"), "ID_CONDICAO": ("CONDICAO_PAGAMENTO", "ID_CONDICAO")},
    },
    "PROGRAMACAO_PAGAMENTO": {
        "bucket_by": ["ID_NF_ENTRADA"],  # an invoice's installments are replaced together
        "schema": [("ID_PROG_PAGAMENTO", T.LongType()), ("ID_NF_ENTRADA", T.LongType()), ("DATA_VENCIMENTO", T.DateType()),
                   ("NUM_PARCELA", T.IntegerType()), ("VALOR_PARCELA", T.DecimalType(21, 13)), ("STATUS_PAGAMENTO", _s(255))],
        "keys": ["ID_NF_ENTRADA", "NUM_PARCELA"], "identity": "ID_PROG_PAGAMENTO", "not_null": ["NUM_PARCELA", "STATUS_PAGAMENTO"],
        "references": {"ID_NF_ENTRADA": ("NOTAS_FISCAIS_ENTRADA", "ID_NF_ENTRADA")},
    },
}


def _plain(t: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(t, T.VarcharType) else t


def table_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, _plain(t), True) for c, t in TABLES[name]["schema"]])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast ``df`` to the table's types (columns it lacks are left out)."""
    types = {c: _plain(t) for c, t in TABLES[name]["schema"]}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def violations(df: DataFrame, name: str, parents: Callable[[str], DataFrame]) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with what its checks need, and per constraint of the table the
    condition that breaks it (X2-X4): ``null_key`` (a business key is not
    set, so the row could never be matched again), ``null_value``,
    ``too_long`` and ``no_parent`` (a set foreign key without its row)."""
    spec = TABLES[name]
    have = set(df.columns)

    def any_of(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, conditions, F.lit(False))

    lengths = {c: t.length for c, t in spec["schema"] if isinstance(t, T.VarcharType) and c in have}
    broken = {
        "null_key": any_of([F.col(k).isNull() for k in spec["keys"]]),
        "null_value": any_of([F.col(c).isNull() for c in spec.get("not_null", []) if c in have and c not in spec["keys"]]),
        "too_long": any_of([F.coalesce(F.length(c) > n, F.lit(False)) for c, n in lengths.items()]),
    }
    orphans = []
    for c, (parent, key) in spec.get("references", {}).items():
        if c in have:
            mark = f"__lf_has_{c}"
            known = parents(parent).select(F.col(key)).distinct().withColumn(mark, F.lit(True))
            df = lookup_join(df, known.withColumnRenamed(key, "__lf_parent"), [c], ["__lf_parent"], "left")
            orphans.append(F.col(c).isNotNull() & F.col(mark).isNull())
    broken["no_parent"] = any_of(orphans)
    return df, broken


def loadable(df: DataFrame, name: str, parents: Callable[[str], DataFrame]) -> tuple[DataFrame, Observation]:
    """The rows of ``df`` that keep the table's constraints, and the number of
    others by constraint, observed when the rows are first read whole."""
    columns = df.columns
    df, broken = violations(df, name, parents)
    obs = Observation(f"rejected-{name}")
    marked = df.select("*", *[c.alias(f"__lf_{k}") for k, c in broken.items()])
    marked = marked.observe(obs, *[F.count_if(F.col(f"__lf_{k}")).alias(k) for k in broken])
    ok = reduce(lambda a, b: a & b, [~F.col(f"__lf_{k}") for k in broken])
    return marked.where(ok).select(*columns), obs


def _counts(merge: Mapping[str, int], rejected: Observation) -> dict[str, int]:
    """INSERT and UPDATE, and the rejected rows where there are any."""
    found = {f"rejected_{k}": int(v) for k, v in rejected.get.items() if v}
    return {"INSERT": int(merge.get("INSERT", 0)), "UPDATE": int(merge.get("UPDATE", 0)), **found}


@dataclass
class LakeTables:
    spark: SparkSession
    root: str
    keep_versions: int | None = None  # older ones are deleted after a switch; None: all stay
    buckets: int | None = None  # rewrite by bucket; None: a version is the whole table
    collation: str | None = DDL_COLLATION  # of text keys in the merge
    stale_after: float = 24 * 3600.0  # seconds after which an unfinished writer's claim no longer counts

    def bucketed(self, name: str) -> BucketTable:
        spec = TABLES[name]
        return BucketTable(self.spark, f"{self.root.rstrip('/')}/{name}", table_schema(name), spec["keys"], self.buckets,
                           collation=self._collation(name), identity_col=spec["identity"], stale_after=self.stale_after, bucket_by=spec.get("bucket_by"))

    def _collation(self, name: str) -> str | None:
        text = any(isinstance(_plain(t), T.StringType) for c, t in TABLES[name]["schema"] if c in TABLES[name]["keys"])
        return self.collation if text else None

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, name: str, complete: bool = True) -> list[str]:
        """Version folders, oldest first; only those with ``_SUCCESS`` unless
        ``complete=False`` (then failed attempts are listed too)."""
        p, fs = self._fs(f"{self.root.rstrip('/')}/{name}")
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            child = st.getPath()
            if st.isDirectory() and child.getName().startswith("v"):
                if not complete or fs.exists(child.suffix("/_SUCCESS")):
                    out.append(child.toString())
        return sorted(out, key=_version)

    def read(self, name: str) -> DataFrame:
        if self.buckets:
            return self.bucketed(name).read()
        vs = self.versions(name)
        if not vs:
            return self.spark.createDataFrame([], table_schema(name))
        return self.spark.read.parquet(vs[-1])

    def upsert(self, name: str, source: DataFrame, **kw) -> dict[str, int]:
        spec = TABLES[name]
        if self.buckets:
            return self._upsert_buckets(name, source, **kw)
        folder = f"{self.root.rstrip('/')}/{name}"
        nxt = self._next_version(name)
        # the claim is held before the table is read: what the merge and the
        # new ids go by cannot change meanwhile
        with claims.claimed(self.spark, f"{folder}/_claims/v{nxt:06d}", f"version {nxt} of {name}"):
            target = self.read(name)
            # a shuffle moves both sides: size its partitions for the two
            with sized_shuffle(self.spark, target, source):
                source, rejected = loadable(conform(source, name), name, self.read)
                res = upsert_snapshot(target, source, spec["keys"], identity_col=spec["identity"], collation=self._collation(name), **kw)
                merged, obs = merge_observation(res.merged, f"upsert-{name}")
                write_parquet(merged.drop("_action"), f"{folder}/v{nxt:06d}", mode="errorifexists")
                res.close()
        if self.keep_versions:
            for old in self.versions(name)[: -self.keep_versions]:
                claims.delete(self.spark, old)
        return _counts(obs.get, rejected)

    def _next_version(self, name: str) -> int:
        """The number past every folder and claim. Raises while an unfinished
        version is claimed (see ``stale_after``)."""
        folder = f"{self.root.rstrip('/')}/{name}"
        done = {_version(v) for v in self.versions(name)}
        seen = [_version(v) for v in self.versions(name, complete=False)]
        for c in claims.children(self.spark, f"{folder}/_claims", dirs=False):
            v = _version(f"/{c}")
            # versions that are done may have been deleted since
            if v > max(done, default=0) and claims.age(self.spark, f"{folder}/_claims/{c}") < self.stale_after:
                raise claims.ConcurrentWriteError(f"version {v} of {name} is being written by another writer")
            seen.append(v)
        return max(seen, default=0) + 1

    def _upsert_buckets(self, name: str, source: DataFrame, **kw) -> dict[str, int]:
        source, rejected = loadable(conform(source, name), name, self.read)
        table = self.bucketed(name)
        merge = table.upsert(source, **kw)
        if self.keep_versions:
            table.vacuum(self.keep_versions)
        return _counts(merge, rejected)

    def invoices_with_counts(self, invoices: DataFrame | None = None) -> DataFrame:
        """Invoices (default: all) with the installment count of their payment term."""
        terms = self.read("CONDICAO_PAGAMENTO").select("ID_CONDICAO", "QTD_PARCELAS")
        invoices = self.read("NOTAS_FISCAIS_ENTRADA") if invoices is None else invoices
        invoices = invoices.select("ID_NF_ENTRADA", "DATA_EMISSAO", "VALOR_TOTAL", "ID_CONDICAO")
        return lookup_join(invoices, terms, ["ID_CONDICAO"], ["ID_CONDICAO"], "left")


def _version(path: str) -> int:
    return int(path.rstrip("/").rsplit("/v", 1)[1])


@dataclass
class JdbcTables:
    spark: SparkSession
    cfg: J.JdbcConfig
    method: str = "merge"

    num_partitions: int | None = None

    def read(self, name: str) -> DataFrame:
        """Whole-table read, split into parallel range scans on the identity
        (or single integer key) column."""
        spec = TABLES[name]
        types = dict(spec["schema"])
        col = spec["identity"]
        if col is None and len(spec["keys"]) == 1 and isinstance(types[spec["keys"][0]], (T.IntegerType, T.LongType)):
            col = spec["keys"][0]
        if col is None:
            return J.read_jdbc(self.spark, self.cfg, table=name)
        parts = self.num_partitions or self.spark.sparkContext.defaultParallelism
        return J.read_jdbc(self.spark, self.cfg, table=name, partition_column=col, num_partitions=parts)

    def upsert(self, name: str, source: DataFrame, **kw) -> dict[str, int]:
        spec = TABLES[name]
        source, rejected = loadable(conform(source, name), name, self.read)
        merge = J.upsert_jdbc(source, self.cfg, name, spec["keys"], column_types=J.stage_types(source, self.cfg),
                              update_keys=True, method=self.method, **kw)
        return _counts(merge, rejected)

    def invoices_with_counts(self) -> DataFrame:
        """Invoices with the installment count of their payment term, joined
        by the database (S5, J6)."""
        return J.read_jdbc(self.spark, self.cfg, query=invoices_query(self.cfg))


def invoices_query(cfg: J.JdbcConfig) -> str:
    q = cfg.q
    columns = ", ".join(f"a.{q(c)}" for c in ("ID_NF_ENTRADA", "DATA_EMISSAO", "VALOR_TOTAL", "ID_CONDICAO"))
    return f"SELECT {columns}, b.{q('QTD_PARCELAS')} FROM NOTAS_FISCAIS_ENTRADA a LEFT JOIN CONDICAO_PAGAMENTO b ON a.{q('ID_CONDICAO')} = b.{q('ID_CONDICAO')}"


def pending_rows(schedule: DataFrame, pending_label: str, columns: Sequence[str]) -> DataFrame:
    """Rows of the stored schedule that are still pending."""
    return schedule.where(F.col("STATUS_PAGAMENTO") == pending_label).select(*columns)
