"""The replay of an event list by the registered SQL, for comparison with the jobs."""

from __future__ import annotations

import duckdb
import pandas as pd

from edops.plans.oracles import fold_sql, ledger_sql


def replay(rows: list[dict], minutes: int | None) -> tuple[dict[int, str], list[dict], list[dict]]:
    """(outcome per order number, open visits, closed visits) of events in order of ``seq``."""
    con = duckdb.connect()
    kinds = {"seq": "BIGINT", "triage_level": "INT", "age": "INT", "event_ts": "TIMESTAMP"}
    vitals = ("heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score")
    kinds |= dict.fromkeys(vitals, "DOUBLE")
    con.register("given", pd.DataFrame(rows).astype(object).where(lambda d: d.notna(), None))
    typed = ", ".join(f"CAST({c} AS {kinds.get(c, 'VARCHAR')}) AS {c}" for c in rows[0])
    con.execute(f"CREATE TABLE given_events AS SELECT {typed} FROM given")
    con.execute(f"CREATE TABLE booked AS {ledger_sql('given_events', minutes=minutes)}")
    outcomes = dict(con.execute("SELECT seq, outcome FROM booked").fetchall())
    cursor = con.execute(fold_sql("booked"))
    names = [d[0] for d in cursor.description]
    stays = [dict(zip(names, r)) for r in cursor.fetchall()]
    return outcomes, [s for s in stays if not s["completed"]], [s for s in stays if s["completed"]]
