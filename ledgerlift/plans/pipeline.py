"""The whole run: bronze, silver, gold, segmentation and the output check.

Each run writes a folder of its own and names the previous one, so a failed run
leaves the last tables untouched. Every layer reads the tables the layer below
has written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerlift.operators import quality
from ledgerlift.plans import gold, segmentation, silver
from ledgerlift.sources import quotes, readers

LANDING = {
    "meta": readers.read_csv,
    "categoria": readers.read_csv,
    "conta_pagar": readers.read_tabular,
    "conta_receber": readers.read_tabular,
    "cliente": readers.read_json_array,
}
# Tables kept by month, with the day that decides.
BY_MONTH = {"transactions_enriched": "data_referencia", "transaction_fact": "transaction_date"}
DIMENSIONS = ["date_dim", "currency_dim", "customer_dim", "category_dim", "account_dim"]


@dataclass
class Run:
    """One run: folder ``root``, run time and the folder of the previous run, if any."""

    spark: SparkSession
    root: str
    run_ts: datetime
    previous: str | None = None
    broken: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.previous is not None and self.previous.rstrip("/") == self.root.rstrip("/"):
            raise ValueError("a run cannot read the folder that it writes")

    def path(self, table: str) -> str:
        if table.endswith("_raw"):
            layer = "bronze"
        elif table.endswith("_transformed"):
            layer = "silver"
        else:
            layer = "gold"
        return f"{self.root}/{layer}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(table)}.parquet")

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table, the star's facts by month; the limits of a star table are counted by the job that writes it."""
        path, limits = f"{self.path(table)}.parquet", gold.LIMITS.get(table)
        counts = Observation(f"{table}-{uuid.uuid4().hex}")
        df = df.observe(counts, *quality.limit_counts(limits)) if limits else df
        written = readers.write_months(df, path, BY_MONTH[table]) if table in BY_MONTH else readers.write_parquet(df, path)
        if limits:
            self.broken[table] = quality.broken_limits(counts.get)
        return written

    def before(self, table: str) -> DataFrame | None:
        """The table of the previous run; None on a first run."""
        if self.previous is None:
            return None
        return Run(self.spark, self.previous, self.run_ts).read(table)


def run_bronze(
    run: Run,
    files: dict[str, str],
    payloads: DataFrame,
    as_of: date | None = None,
    currencies: list[str] | None = None,
    lookback_days: int = quotes.LOOKBACK_DAYS,
    json_lines: bool = False,
) -> None:
    """Land the five files and the quotes; ``json_lines`` says that customers come as JSON lines, not as an array.

    With ``as_of`` only the newest quote of each of ``currencies`` in the lookback
    window is kept, and ``missing_quotes`` lists those without one; else the whole
    landed history is kept. Without any quote the previous run's
    quotes stand in; without those the run fails.
    """
    for name, read in LANDING.items():
        if json_lines and read is readers.read_json_array:
            rows = readers.read_json(run.spark, files[name], readers.SCHEMAS[name], multi_line=False)
        else:
            rows = read(run.spark, files[name], readers.SCHEMAS[name])
        run.write(readers.with_lineage(rows, name, run.run_ts, files[name]), f"{name}_raw")
    landed = quotes.flatten_payloads(payloads)
    if as_of is not None:
        landed = quotes.latest_quotes(landed, F.lit(as_of), currencies, lookback_days)
        run.write(quotes.missing_currencies(run.spark, landed, currencies), "missing_quotes")
    landed = quotes.with_quote_lineage(landed, run.run_ts)
    persisted = run.before("bcb_exchange_rates_raw")
    chosen = landed if persisted is None else quotes.fresh_or_cached(landed, persisted)
    quotes.require_quotes(run.write(chosen, "bcb_exchange_rates_raw"))


def run_silver(run: Run) -> None:
    for name, clean in silver.CLEANERS.items():
        source = "bcb_exchange_rates_raw" if name == "exchange_rates" else f"{name}_raw"
        run.write(silver.finalize(clean(run.read(source)), run.run_ts), f"{name}_transformed")


def run_gold(run: Run) -> None:
    """Dimensions (upserted on the previous run's), facts and summaries."""
    payables, receivables = run.read("conta_pagar_transformed"), run.read("conta_receber_transformed")
    customers, categories = run.read("cliente_transformed"), run.read("categoria_transformed")
    rates = run.read("exchange_rates_transformed")

    dates = run.write(gold.date_dim(gold.date_range(payables, receivables), run.before("date_dim")), "date_dim")
    currencies = run.write(gold.currency_dim(rates, customers, run.before("currency_dim")), "currency_dim")
    people = run.write(gold.customer_dim(customers, run.run_ts, run.before("customer_dim")), "customer_dim")
    kinds = run.write(gold.category_dim(categories, run.before("category_dim")), "category_dim")
    accounts = run.write(gold.account_dim(kinds, run.before("account_dim")), "account_dim")
    dims = {"date": dates, "currency": currencies, "customer": people, "account": accounts}

    enriched = run.write(
        gold.enrich(payables, receivables, customers, categories, rates, dims=dims), "transactions_enriched"
    )
    gold.require_transactions(enriched)
    facts = run.write(gold.transaction_fact(enriched, run.run_ts), "transaction_fact")
    quoted = run.write(gold.exchange_rate_fact(rates, currencies, run.run_ts), "exchange_rate_fact")
    require_constraints(dims | {"category": kinds}, facts, quoted, run.broken)
    for name, keys in gold.SUMMARY_KEYS.items():
        readers.write_gold(getattr(gold, name)(enriched), run.path(name), keys)


def reload_months(run: Run, months: list[str]) -> None:
    """Enriched transactions and facts of some months (yyyy-MM) again, from the tables of this run; other months stay."""
    payables, receivables = run.read("conta_pagar_transformed"), run.read("conta_receber_transformed")
    day = F.date_format(F.expr(gold.REFERENCE_DAY), "yyyy-MM")
    dims = {n: run.read(f"{n}_dim") for n in ("date", "currency", "customer", "account")}
    enriched = gold.enrich(
        payables.filter(day.isin(months)), receivables.filter(day.isin(months)), run.read("cliente_transformed"),
        run.read("categoria_transformed"), run.read("exchange_rates_transformed"), dims=dims,
    )
    written = run.write(enriched, "transactions_enriched").filter(F.col(readers.MONTH).isin(months))
    run.write(gold.transaction_fact(written, run.run_ts), "transaction_fact")
    if run.broken["transaction_fact"]:
        raise ValueError(f"constraints violated: {run.broken['transaction_fact']}")


def require_constraints(
    dims: dict[str, DataFrame], facts: DataFrame, quoted: DataFrame, broken_limits: dict[str, list[str]] | None = None
) -> None:
    """Fail on a repeated key, an orphan or a broken limit of the star schema; before anything is published.

    ``broken_limits`` are the columns that the writing jobs found; without them each table is read for it.
    """
    tables = {f"{n}_dim": t for n, t in dims.items()} | {"transaction_fact": facts, "exchange_rate_fact": quoted}
    unique = quality.union_all([quality.duplicate_keys(tables[t], t, keys) for t, keys in gold.UNIQUE_KEYS.items()])
    orphans = quality.union_all(
        [quality.orphan_rows(tables[t], tables[p], t, column, column) for t, column, p in gold.FOREIGN_KEYS]
    )
    if broken_limits is None:
        limits = quality.union_all([quality.limit_violations(tables[t], t, limit) for t, limit in gold.LIMITS.items()])
        over = " + ".join(quality.BROKEN)
        found = [f"{r.tabela}: {r.coluna}" for r in limits.filter(f"{over} > 0").collect()]
    else:
        found = [f"{t}: {c}" for t, columns in broken_limits.items() for c in columns]
    broken = [f"{r.tabela}: repeated {r.chave}" for r in unique.filter("chaves_repetidas > 0").collect()]
    broken += [f"{r.tabela}: orphans in {r.coluna}" for r in orphans.filter("orfaos > 0").collect()]
    broken += found
    if broken:
        raise ValueError(f"constraints violated: {', '.join(sorted(broken))}")


def run_segments(run: Run, settings: segmentation.Settings | None = None) -> None:
    """Segments, their reports and the customer dimension with the new labels."""
    result = segmentation.run_segmentation(run.read("customer_summary"), settings)
    if result is None:
        return
    segments = readers.write_gold(result.segments, run.path("customer_segments"))
    readers.write_gold(result.metrics_table(run.spark), run.path("metricas_clusterizacao"))
    readers.write_gold(result.analysis_table(run.spark), run.path("analise_k"))
    readers.write_gold(result.profile(), run.path("metricas_por_cluster"))
    labelled = run.write(gold.write_back_clusters(run.read("customer_dim"), segments), "customer_dim_labelled")
    run.write(labelled, "customer_dim")


def audit(run: Run) -> DataFrame:
    """(table, present, rows) of the expected outputs."""
    found = {}
    for name in gold.EXPECTED_OUTPUTS:
        try:
            found[name] = run.read(name)
        except AnalysisException:
            continue
    return gold.output_audit(run.spark, found)


def validate(run: Run) -> None:
    missing = [r.tabela for r in audit(run).filter("NOT presente").collect()]
    if missing:
        raise FileNotFoundError(f"expected outputs missing: {', '.join(sorted(missing))}")


def run_all(
    run: Run,
    files: dict[str, str],
    payloads: DataFrame,
    as_of: date | None = None,
    settings: segmentation.Settings | None = None,
    currencies: list[str] | None = None,
    lookback_days: int = quotes.LOOKBACK_DAYS,
    json_lines: bool = False,
) -> None:
    """Everything; the arguments of ``run_bronze`` and ``run_segments`` are passed on."""
    run_bronze(run, files, payloads, as_of, currencies, lookback_days, json_lines)
    run_silver(run)
    run_gold(run)
    run_segments(run, settings)
    validate(run)
