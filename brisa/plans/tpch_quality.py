"""Data-quality suite over the mapped model (Q1-Q13).

Each group returns rows ``(check_name, relation, column_name, severity,
failures, status)``; ``SQL`` holds the matching DuckDB queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.key_checks import ForeignKey, UniqueKey, key_checks
from .oracle_sql import B
from .tpch import Model

EVENT_LABELS = ["clear", "windy", "snow", "fog", "storm"]
# Fixed values of the mapping: five of the six part types are accepted, so the
# sixth is reported.
ACCEPTED_PART_TYPES = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL"]
COND_NOT_NULL = ["movement_id", "origin", "destination", "movement_date", "origin_event", "destination_event"]


def not_null(m: Model) -> DataFrame:
    return q.relation_checks(m.conditions(), q.RelationChecks("movements_with_conditions", not_null=COND_NOT_NULL))


def _unique_rules(m: Model) -> list:
    return [
        UniqueKey("stg_movements", m.stg_movements(), ["movement_id"]),
        UniqueKey("lineitem", m.t("lineitem"), ["l_orderkey", "l_linenumber"], severity="warn"),
        UniqueKey("traffic_baseline", m.baseline(), ["hub", "month"]),
    ]


def _foreign_rules(m: Model) -> list:
    return [
        ForeignKey("recovery", m.recovery(), "hub", m.dim_place(), "station"),
        ForeignKey("lineitem", m.t("lineitem"), "l_partkey", m.t("part"), "p_partkey", dense=True),
        ForeignKey("stg_movements", m.stg_movements(), "carrier", m.dim_carrier(), "carrier", severity="warn"),
    ]


def unique(m: Model) -> DataFrame:
    return key_checks(_unique_rules(m))


def foreign_keys(m: Model) -> DataFrame:
    return key_checks(_foreign_rules(m))


def accepted(m: Model) -> DataFrame:
    return q.union_checks(
        [
            q.relation_checks(m.resilience(), q.RelationChecks("resilience", accepted={"event": EVENT_LABELS})),
            q.relation_checks(m.t("part"), q.RelationChecks("part", accepted={"p_type": ACCEPTED_PART_TYPES})),
        ]
    )


def ranges(m: Model) -> DataFrame:
    return q.union_checks(
        [
            q.relation_checks(
                m.conditions(), q.RelationChecks("movements_with_conditions", ranges=[q.RangeRule("duration_minutes", 0, 5_000_000)])
            ),
            q.relation_checks(
                m.recovery(),
                q.RelationChecks(
                    "recovery",
                    ranges=[q.RangeRule("recovery_ratio", 0, 1.5, row_condition=F.col("year") > B, severity="warn")],
                ),
            ),
            q.relation_checks(m.t("orders"), q.RelationChecks("orders", ranges=[q.RangeRule("o_totalprice", 0, 400000)])),
        ]
    )


def row_counts(m: Model) -> DataFrame:
    return q.union_checks(
        [
            q.relation_checks(m.conditions(), q.RelationChecks("movements_with_conditions", row_count_between=(1000, 10_000_000))),
            q.relation_checks(m.route_risk(), q.RelationChecks("route_risk", row_count_between=(7000, 12000))),
        ]
    )


def means(m: Model) -> DataFrame:
    return q.relation_checks(
        m.conditions(), q.RelationChecks("movements_with_conditions", mean_between={"duration_minutes": (60, 300)})
    )


def singular(m: Model) -> DataFrame:
    cond = m.conditions()
    return q.union_checks(
        [
            q.landing_before_takeoff(cond, "movements_with_conditions", "first_seen_at", "last_seen_at"),
            q.keys_missing(m.hubs(), "station", m.baseline(), "hub", "every_hub_has_baseline", "hubs"),
            q.bucket_within_day(
                cond,
                "movements_with_conditions",
                "movement_date",
                [("origin_event", "first_seen_at"), ("destination_event", "last_seen_at")],
            ),
        ]
    )


GROUPS = {
    "dq_not_null": not_null,
    "dq_unique": unique,
    "dq_fk": foreign_keys,
    "dq_accepted": accepted,
    "dq_range": ranges,
    "dq_rowcount": row_counts,
    "dq_mean": means,
    "dq_singular": singular,
}


def summary(m: Model) -> DataFrame:
    """Q13 over the same checks as the groups above, folded so that every
    column-level and row-condition check of a relation is one aggregate pass."""
    cond = m.conditions()
    folded = [
        q.relation_checks(
            cond,
            q.RelationChecks(
                "movements_with_conditions",
                not_null=COND_NOT_NULL,
                ranges=[q.RangeRule("duration_minutes", 0, 5_000_000)],
                mean_between={"duration_minutes": (60, 300)},
                row_count_between=(1000, 10_000_000),
                singular={
                    "no_end_before_start": F.col("last_seen_at") < F.col("first_seen_at"),
                    "observation_within_day": q.outside_day(
                        "movement_date", [("origin_event", "first_seen_at"), ("destination_event", "last_seen_at")]
                    ),
                },
            ),
        ),
        q.relation_checks(m.resilience(), q.RelationChecks("resilience", accepted={"event": EVENT_LABELS})),
        q.relation_checks(m.t("part"), q.RelationChecks("part", accepted={"p_type": ACCEPTED_PART_TYPES})),
        q.relation_checks(
            m.recovery(),
            q.RelationChecks(
                "recovery", ranges=[q.RangeRule("recovery_ratio", 0, 1.5, row_condition=F.col("year") > B, severity="warn")]
            ),
        ),
        q.relation_checks(m.t("orders"), q.RelationChecks("orders", ranges=[q.RangeRule("o_totalprice", 0, 400000)])),
        q.relation_checks(m.route_risk(), q.RelationChecks("route_risk", row_count_between=(7000, 12000))),
        key_checks(
            [
                *_unique_rules(m),
                *_foreign_rules(m),
                ForeignKey("hubs", m.hubs(), "station", m.baseline(), "hub", check="every_hub_has_baseline"),
            ]
        ),
    ]
    return q.summary(folded)


# --- SQL ---------------------------------------------------------------------


def _row(check: str, rel: str, col: str, sev: str, failures: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{rel}' AS relation, '{col}' AS column_name, '{sev}' AS severity, "
        f"CAST(({failures}) AS BIGINT) AS failures, "
        f"CASE WHEN ({failures}) = 0 THEN 'pass' WHEN '{sev}' = 'warn' THEN 'warn' ELSE 'error' END AS status"
    )


def _u(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _inlist(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


SQL_BODIES = {
    "dq_not_null": _u(
        *[
            _row("not_null", "movements_with_conditions", c, "error", f"SELECT count(*) FROM cond WHERE {c} IS NULL")
            for c in COND_NOT_NULL
        ]
    ),
    "dq_unique": _u(
        _row(
            "unique",
            "stg_movements",
            "movement_id",
            "error",
            "SELECT count(*) FROM (SELECT movement_id FROM stg_movements WHERE movement_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
        ),
        _row(
            "unique_combination",
            "lineitem",
            "l_orderkey,l_linenumber",
            "warn",
            "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)",
        ),
        _row(
            "unique_combination",
            "traffic_baseline",
            "hub,month",
            "error",
            "SELECT count(*) FROM (SELECT hub, month FROM baseline GROUP BY 1, 2 HAVING count(*) > 1)",
        ),
    ),
    "dq_fk": _u(
        _row(
            "relationships",
            "recovery",
            "hub",
            "error",
            "SELECT count(*) FROM recovery r WHERE r.hub IS NOT NULL AND r.hub NOT IN (SELECT station FROM dim_place WHERE station IS NOT NULL)",
        ),
        _row(
            "relationships",
            "lineitem",
            "l_partkey",
            "error",
            "SELECT count(*) FROM lineitem l WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)",
        ),
        _row(
            "relationships",
            "stg_movements",
            "carrier",
            "warn",
            "SELECT count(*) FROM stg_movements s WHERE s.carrier IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_carrier d WHERE d.carrier = s.carrier)",
        ),
    ),
    "dq_accepted": _u(
        _row(
            "accepted_values",
            "resilience",
            "event",
            "error",
            f"SELECT count(DISTINCT event) FROM resilience WHERE event NOT IN ({_inlist(EVENT_LABELS)})",
        ),
        _row(
            "accepted_values",
            "part",
            "p_type",
            "error",
            f"SELECT count(DISTINCT p_type) FROM part WHERE p_type NOT IN ({_inlist(ACCEPTED_PART_TYPES)})",
        ),
    ),
    "dq_range": _u(
        _row(
            "range",
            "movements_with_conditions",
            "duration_minutes",
            "error",
            "SELECT count(*) FROM cond WHERE duration_minutes < 0 OR duration_minutes > 5000000",
        ),
        _row(
            "range",
            "recovery",
            "recovery_ratio",
            "warn",
            f"SELECT count(*) FROM recovery WHERE year > {B} AND (recovery_ratio < 0 OR recovery_ratio > 1.5)",
        ),
        _row("range", "orders", "o_totalprice", "error", "SELECT count(*) FROM orders WHERE o_totalprice < 0 OR o_totalprice > 400000"),
    ),
    "dq_rowcount": _u(
        _row(
            "row_count",
            "movements_with_conditions",
            "*",
            "error",
            "SELECT CASE WHEN count(*) < 1000 OR count(*) > 10000000 THEN 1 ELSE 0 END FROM cond",
        ),
        _row("row_count", "route_risk", "*", "error", "SELECT CASE WHEN count(*) < 7000 OR count(*) > 12000 THEN 1 ELSE 0 END FROM route_risk"),
    ),
    "dq_mean": _row(
        "mean_range",
        "movements_with_conditions",
        "duration_minutes",
        "error",
        "SELECT CASE WHEN avg(duration_minutes) < 60 OR avg(duration_minutes) > 300 THEN 1 ELSE 0 END FROM cond",
    ),
    "dq_singular": _u(
        _row("no_end_before_start", "movements_with_conditions", "*", "error", "SELECT count(*) FROM cond WHERE last_seen_at < first_seen_at"),
        _row(
            "every_hub_has_baseline",
            "hubs",
            "station",
            "error",
            "SELECT count(*) FROM hubs h WHERE NOT EXISTS (SELECT 1 FROM baseline b WHERE b.hub = h.station)",
        ),
        _row(
            "observation_within_day",
            "movements_with_conditions",
            "*",
            "error",
            """SELECT count(*) FROM cond WHERE
   (origin_event IS NOT NULL AND abs(date_diff('day', movement_date, CAST(first_seen_at AS DATE))) > 1)
   OR (destination_event IS NOT NULL AND abs(date_diff('day', movement_date, CAST(last_seen_at AS DATE))) > 1)""",
        ),
    ),
}
SQL_BODIES["dq_summary"] = (
    "SELECT status, count(*) AS n_checks FROM (\n" + _u(*[f"SELECT * FROM ({b})" for b in SQL_BODIES.values()]) + "\n) c GROUP BY status"
)
