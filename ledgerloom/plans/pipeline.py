"""Whole jobs over the stored tables: load a statement, refresh the reporting table, onboard members."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import DataFrame, Observation, functions as F

from ledgerloom.operators import audit, loaders, onboarding
from ledgerloom.operators.bank_rules import BANKS
from ledgerloom.operators.mining import bank_id_of, enrich
from ledgerloom.operators.quality import longest_breach
from ledgerloom.operators.sinks import Warehouse, cascade_delete, month_number, untouched, untouched_counted
from ledgerloom.plans import reports
from ledgerloom.schemas import MONTH, MONTHLY_SUMS, REPORTING, RUN_COUNTS
from ledgerloom.session import counted, stage, staging_scope


def refreshed(
    transactions: DataFrame, categories: DataFrame, sub_categories: DataFrame, banks: DataFrame, as_of: datetime
) -> DataFrame:
    """Reporting rows of all banks in one plan."""
    parts = refreshed_by_bank(transactions, categories, sub_categories, banks, as_of)
    return reduce(DataFrame.unionByName, [rows for _, rows in parts])


def refreshed_by_bank(
    transactions: DataFrame, categories: DataFrame, sub_categories: DataFrame, banks: DataFrame, as_of: datetime
) -> list[tuple[int, DataFrame]]:
    """Id and reporting rows of each bank."""
    ids = [(bank, bank_id_of(banks, rules)) for bank, rules in BANKS.items()]
    return [(n, enrich(bank, transactions, categories, sub_categories, n, as_of)) for bank, n in ids]


def _alone(job: Callable) -> Callable:
    """A job of a ledger that has its turn to itself, if the ledger waits for turns."""
    @wraps(job)
    def run(self, *args, **options):
        with nullcontext() if self.wait is None else self.store.only_writer(self.wait):
            return job(self, *args, **options)

    return run


class Ledger:
    """Jobs that write.  Everything is computed and staged before the first table is touched.

    Each job can be run again after a failure: names and ids that made it into
    the tables are found there, and the rest is added.  ``keep_counts`` adds a
    table with the rows that each run inserted, replaced and rejected.  With
    ``wait`` (seconds) jobs of several drivers or threads take turns, so no id
    is given and no name added twice; a job whose turn does not come raises
    TimeoutError before it logs or writes.  Without it, let one writer run at a time.
    """

    def __init__(
        self, warehouse: Warehouse, clock: Callable[[], datetime] = datetime.now, keep_counts: bool = False,
        wait: float | None = None,
    ):
        self.store, self.clock, self.keep_counts, self.wait = warehouse, clock, keep_counts, wait
        if keep_counts:
            warehouse.create(RUN_COUNTS.name)

    def _write_log(self, entry: dict) -> None:
        self.store.append("ETL_LOG", audit.log_frame(self.store.spark, [entry]))

    @contextmanager
    def _logged(self, proc: str, bank_id: int | None = None) -> Iterator[dict]:
        """A STARTED row before the work; SUCCESS with ``rows`` or FAILED with the message after it.

        What the work names as ``inserted``, ``replaced`` or ``rejected`` is kept under the same log id.
        """
        entry = audit.log_row(self.store.read("ETL_LOG"), proc, bank_id, self.clock())
        self._write_log(entry)
        outcome = {"rows": 0}
        try:
            with staging_scope(self.store.spark):
                yield outcome
        except Exception as error:
            self._write_log(audit.finished(entry, self.clock(), error=str(error)))
            raise
        self._write_log(audit.finished(entry, self.clock(), rows=outcome["rows"]))
        if self.keep_counts:
            self._write_counts(entry["LOG_ID"], outcome)

    def _write_counts(self, log_id: int, outcome: dict) -> None:
        row = (log_id, *(outcome.get(k) for k in ("inserted", "replaced", "rejected")))
        self.store.append(RUN_COUNTS.name, self.store.spark.createDataFrame([row], RUN_COUNTS.schema))

    def runs(self) -> DataFrame:
        """The latest state of every run, with rows inserted, replaced and rejected where the job worked them out.

        It needs the table of ``keep_counts``; a run that failed, or was made without it, has nulls.
        """
        return audit.latest(self.store.read("ETL_LOG")).join(self.store.read(RUN_COUNTS.name), "LOG_ID", "left")

    def dimensions(self) -> loaders.Dimensions:
        read = self.store.read
        return loaders.Dimensions(
            read("MCC_CATEGORY"), read("MCC_SUB_CATEGORY"), read("BANKS"), read("MEMBERS"), read("CARDS")
        )

    @_alone
    def load(
        self, bank: str, landing: DataFrame, user_name: str, bank_name: str, card_last4: str,
        rejects_path: str | None = None, **options,
    ) -> int:
        """Load one statement and return the number of new facts.

        Rejected rows go to ``rejects_path`` if one is given.  A failed load is
        logged and raised; an unknown owner is raised before anything is logged.
        """
        dims = self.dimensions()
        owner = loaders.resolve(dims, user_name, bank_name, card_last4)
        with self._logged(f"load_{bank.lower()}", owner["bank"]) as outcome:
            result = loaders.load_statement(
                bank, landing, dims, self.store.read("TRANSACTIONS"), user_name, bank_name, card_last4,
                self.clock(), owner=owner, **options,
            )
            facts, seen = counted(result.transactions, "new-facts")
            outcome["rows"] = outcome["inserted"] = seen["rows"]
            if rejects_path is not None:
                seen = Observation()
                result.rejects.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(rejects_path)
                outcome["rejected"] = seen.get["rows"]
            self.store.append("MCC_CATEGORY", result.new_categories)
            self.store.append("MCC_SUB_CATEGORY", result.new_sub_categories)
            self.store.append("TRANSACTIONS", facts)
        return outcome["rows"]

    def refresh_bank(self, bank: str, since: datetime | None = None) -> dict[str, int]:
        """Replace one bank's reporting rows, or only those of the months that got facts at ``since`` or later.

        Returns how many ``rows`` were written, and how many of them were ``inserted`` and ``replaced``.

        Facts are read, and reporting rows rewritten, by month; the others stay as they were, files and all.  A text over its
        length fails the bank as a whole.
        """
        key, bank_id = list(REPORTING.key), bank_id_of(self.store.read("BANKS"), BANKS[bank])
        months, own = None, F.col("BANK_ID") == bank_id
        if since is not None:
            months = self.store.months("TRANSACTIONS", own & (F.col("ADDED_DATETIME") >= F.lit(since).cast("timestamp_ntz")))
            if not months:
                return {"rows": 0, "inserted": 0, "replaced": 0}
        rows, seen = counted(
            enrich(
                bank, self.store.read("TRANSACTIONS", months), self.store.read("MCC_CATEGORY"),
                self.store.read("MCC_SUB_CATEGORY"), bank_id, self.clock(),
            ),
            f"reporting-{bank.lower()}",
        )
        breach = longest_breach(rows, REPORTING)
        if breach:
            raise ValueError(f"{bank}: data too long for {breach}")
        # A fact keeps its bank and date, so only this bank's partitions of these months can hold its keys.
        stored = self.store.read("TRANSACTION_REPORTING", months).where(own)
        others, hits = untouched_counted(rows, stored, key)
        kept = stage(others, "reporting-kept")
        self.store.overwrite_partition("TRANSACTION_REPORTING", rows.unionByName(kept), months, BANK_ID=bank_id)
        replaced = hits.get["replaced"]
        return {"rows": seen["rows"], "inserted": seen["rows"] - replaced, "replaced": replaced}

    @_alone
    def refresh(self, banks: list[str] | None = None, changed_only: bool = False) -> dict[str, str]:
        """Refresh the banks in order; one that fails is logged and the rest still run.

        ``changed_only`` refreshes the months that got facts since the bank's last refresh that ended well, all if there was
        none.  Rows of other months then keep the category names they were given; after a category has got another name,
        refresh as a whole.
        """
        states, known = {}, self.store.read("BANKS")
        for bank in banks or BANKS:
            bank_id = self._bank_or_none(known, bank)
            since = audit.unseen_since(self.store.read("ETL_LOG"), f"refresh_{bank.lower()}", bank_id) if changed_only else None
            try:
                with self._logged(f"refresh_{bank.lower()}", bank_id) as outcome:
                    outcome |= self.refresh_bank(bank, since)
                states[bank] = "SUCCESS"
            except Exception:
                states[bank] = "FAILED"
        return states

    @staticmethod
    def _bank_or_none(known: DataFrame, bank: str) -> int | None:
        """The bank's id for the log; a bank that is not there fails inside the logged work."""
        try:
            return bank_id_of(known, BANKS[bank])
        except Exception:
            return None

    @_alone
    def summarize(self, whole: bool = False) -> int:
        """Bring the stored monthly sums up to date and return how many were written.

        Only months that got facts since the last summary that ended well are summed again, from their own partitions, so the
        work follows what came in, and a summary that failed is simply made again.  ``whole`` sums all months, as is needed
        after facts were removed.
        """
        since = None if whole else audit.unseen_since(self.store.read("ETL_LOG"), "summarize", None)
        with self._logged("summarize") as outcome:
            self.store.create(MONTHLY_SUMS.name)
            months = None
            if since is not None:
                months = self.store.months("TRANSACTIONS", F.col("ADDED_DATETIME") >= F.lit(since).cast("timestamp_ntz"))
            if months != []:
                sums, seen = counted(reports.monthly_sums(self.store.read("TRANSACTIONS", months)), "monthly-sums")
                self.store.overwrite_partition(MONTHLY_SUMS.name, sums, months)
                outcome["rows"] = seen["rows"]
        return outcome["rows"]

    def monthly_summary(self, **options) -> DataFrame:
        """The monthly summary as of the last ``summarize``; it reads the sums, not the facts."""
        return reports.summary_of_sums(self.store.read(MONTHLY_SUMS.name), **options)

    @_alone
    def onboard(self, applicants: DataFrame, key: str, results_path: str | None = None, **options) -> int:
        """Onboard a frame of applicants and return the number of new dimension rows.

        One result row per applicant goes to ``results_path`` if one is given.
        """
        with self._logged("onboard_members") as outcome:
            now, read = self.clock(), self.store.read
            result = onboarding.onboard(
                applicants, read("MEMBER_ADDRESS"), read("MEMBERS"), read("BANKS"), read("CARDS"), key, now, **options
            )
            created = {
                "MEMBER_ADDRESS": result.new_addresses, "BANKS": result.new_banks, "CARDS": result.new_cards,
            }
            staged, made = {}, result.new_members.count()
            for name, df in created.items():
                staged[name], seen = counted(df, name.lower())
                made += seen["rows"]
            outcome["rows"] = outcome["inserted"] = made
            if results_path is not None:
                result.results.write.parquet(results_path)
            members = stage(onboarding.members_after(read("MEMBERS"), result, now), "members")
            # Parents first: a failure in between leaves no row that points to one not yet there.
            for name in ("MEMBER_ADDRESS", "BANKS"):
                self.store.append(name, staged[name])
            self.store.overwrite("MEMBERS", members)
            self.store.append("CARDS", staged["CARDS"])
        return outcome["rows"]

    @_alone
    def clear_transactions(self) -> None:
        """Empty the fact table and nothing else."""
        self.store.truncate("TRANSACTIONS")

    @_alone
    def cascade(self) -> None:
        """Remove reporting rows whose fact is gone, rewriting only the months of a bank that hold some."""
        rows = self.store.read("TRANSACTION_REPORTING")
        facts = self.store.read("TRANSACTIONS")
        lost = untouched(facts, rows, ["TRANSACTION_ID"]).select("BANK_ID", month_number(REPORTING.month_of).alias(MONTH)).distinct()
        touched: dict[int, list[int]] = {}
        for bank_id, month in lost.collect():
            touched.setdefault(bank_id, []).append(month)
        for bank_id, months in touched.items():
            with staging_scope(self.store.spark):
                here = self.store.read("TRANSACTION_REPORTING", months).where(F.col("BANK_ID") == bank_id)
                kept = stage(cascade_delete(here, facts, "TRANSACTION_ID"), "reporting-kept")
                self.store.overwrite_partition("TRANSACTION_REPORTING", kept, months, BANK_ID=bank_id)
