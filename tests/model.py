"""What each check counts, said once more in plain Python over lists of dicts."""

from collections import defaultdict
from datetime import timedelta
from decimal import Decimal as D


def take(row, names):
    return tuple(row[n] for n in names)


def grouped(rows, names):
    found = defaultdict(list)
    for row in rows:
        found[take(row, names)].append(row)
    return found


def full_join(expected, actual, keys, fields=()):
    """Rows of a full outer join that stand alone or differ."""
    partners = grouped(actual, keys)
    joined, count = set(), 0
    for e in expected:
        key = take(e, keys)
        matches = [] if None in key else partners.get(key, [])
        count += sum(take(e, fields) != take(a, fields) for a in matches) if matches else 1
        if matches:
            joined.add(key)
    return count + sum(take(a, keys) not in joined for a in actual)


def inner_join(left, right, keys):
    partners = grouped(right, keys)
    return [(a, b) for a in left if None not in take(a, keys) for b in partners.get(take(a, keys), [])]


def left_join(left, right, left_keys, right_keys):
    partners = grouped(right, right_keys)
    for row in left:
        key = take(row, left_keys)
        yield from ((row, other) for other in ([] if None in key else partners.get(key, [])) or [None])


def repeated(rows, keys):
    return sum(len(group) > 1 for group in grouped(rows, keys).values())


def against(expected, actual, keys, fields):
    return full_join(expected, actual, keys, fields) + repeated(actual, keys)


def newest(rows, keys, order):
    """One row per key; an unknown value ranks before every known one."""
    def rank(row):
        return [(row[o] is None, row[o] if row[o] is not None else 0) for o in order]

    return [max(group, key=rank) for group in grouped(rows, keys).values()]


def known_sum(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def net(row):
    parts = take(row, ("gross_amount", "discount_amount", "refund_amount"))
    return None if None in parts else parts[0] - parts[1] - parts[2]


def text_net(row):
    return D(row["gross_text"]) - D(row["discount_text"])


def calculated(rows):
    return [{**r, "net_amount": net(r)} for r in rows]


def missing_and_unexpected(t):
    source, target = ({r["order_id"] for r in t[n]} for n in ("source_orders", "target_orders"))
    return len(source ^ target)


def wrong_net(t):
    return sum(a["net_amount"] != b["net_amount"] for a, b in inner_join(calculated(t["source_orders"]), t["target_orders"], ["order_id"]))


def capstone(t):
    return (missing_and_unexpected(t) + wrong_net(t) + repeated(t["target_orders"], ["order_id"])
            + sum(r["net_amount"] is None for r in t["target_orders"])
            + full_join(t["gold_daily_sales"], t["target_daily_sales"], ["order_date"], ["order_count", "net_revenue"]))


def totals_by(rows, key, value):
    return [{key: k, value: known_sum(r[value] for r in group)} for (k,), group in grouped(rows, [key]).items()]


def per_day(rows, shift=timedelta(0)):
    dated = [{**r, "order_date": r["ordered_at"] and (r["ordered_at"] + shift).date()} for r in rows]
    return [{"order_date": d, "order_count": len(group), "net_revenue": known_sum(r["net_amount"] for r in group)}
            for (d,), group in grouped(dated, ["order_date"]).items()]


def arrived(t):
    clock = t["lab_context"][0]["as_of"]
    return [r for r in t["incremental_events"] if r["arrived_at"] is not None and r["arrived_at"] <= clock]


def is_fresh(need, seen):
    moments = take(seen, ("last_success_at", "last_event_at"))
    if seen["execution_status"] != "SUCCESS" or None in moments:
        return False
    if need["as_of"] is None:
        return True
    age = [need["as_of"] - m for m in moments]
    return min(age) >= timedelta(0) and (need["sla_minutes"] is None or max(age) <= timedelta(minutes=need["sla_minutes"]))


def not_fresh(t):
    pairs = left_join(t["freshness_requirements"], t["freshness_observations"], ["dataset_id"], ["dataset_id"])
    return sum(seen is None or not is_fresh(need, seen) for need, seen in pairs)


def history(changes):
    out = []
    for (customer,), group in grouped(newest(changes, ["customer_id", "effective_at"], ["event_id"]), ["customer_id"]).items():
        ordered = sorted((r for r in group if r["effective_at"] is not None), key=lambda r: r["effective_at"])
        ordered += [r for r in group if r["effective_at"] is None]
        for this, following in zip(ordered, [*ordered[1:], None]):
            until = following and following["effective_at"]
            out.append({"customer_id": customer, "tier": this["tier"], "valid_from": this["effective_at"], "valid_to": until, "is_current": until is None})
    return out


def overlapping(a, b):
    return (b["valid_to"] is None or a["valid_from"] < b["valid_to"]) and (a["valid_to"] is None or b["valid_from"] < a["valid_to"])


def type2(t):
    target = t["target_customer_history"]
    spans = [r for r in target if None not in take(r, ("version_id", "customer_id", "valid_from"))]
    overlaps = sum(a["version_id"] < b["version_id"] and overlapping(a, b) for a, b in inner_join(spans, spans, ["customer_id"]))
    currents = sum(sum(r["is_current"] is True for r in group) != 1 for group in grouped(target, ["customer_id"]).values())
    bad = sum(None not in take(r, ("valid_from", "valid_to")) and r["valid_to"] <= r["valid_from"] for r in target)
    return overlaps + currents + bad + against(
        history(t["source_customer_changes"]), target, ["customer_id", "valid_from"], ["tier", "valid_to", "is_current"])


def well_formed(text):
    whole, _, cents = text.partition(".")
    return whole.isdigit() and (not cents and "." not in text or cents.isdigit() and len(cents) <= 2)


def quarantine(t):
    ok = {True: [], False: []}
    for r in t["etl_source"]:
        ok[well_formed(r["gross_text"]) and well_formed(r["discount_text"])].append({**r, "reason": "INVALID_AMOUNT"})
    return full_join(ok[True], t["etl_target"], ["order_id"]) + against(ok[False], t["etl_rejects"], ["order_id"], ["reason"])


def mapped(t):
    return [{"order_id": s["order_id"], "customer_id": c["customer_id"]} for s, c in inner_join(t["etl_source"], t["etl_customers"], ["customer_code"])]


def priced(rows):
    return [{**r, "net_amount": text_net(r)} for r in rows]


def replayed(t):
    upto = t["etl_context"][0]["batch_no"]
    seen = [r for r in t["etl_source"] if r["arrived_batch"] is not None and r["arrived_batch"] <= upto]
    return against(priced(newest(seen, ["order_id"], ["event_id"])), t["etl_target"], ["order_id"], ["event_id", "net_amount"])


def amounts(t):
    return full_join(priced(t["etl_source"]), t["etl_target"], ["order_id"], ["net_amount"])


def last_steps_problem(t):
    numbers = [r["step_no"] for r in t["etl_steps"] if r["step_no"] is not None]
    return sum(r["step_no"] == max(numbers) and take(r, ("execution_status", "checkpoint")) != ("SUCCESS", 1) for r in t["etl_steps"]) if numbers else 0


RECORD = ["customer_id", "amount", "event_id", "updated_at"]


def visible(t):
    context = t["cloud_context"][0]
    seen = [r for r in t["cloud_source"] if r["batch_no"] is not None and r["updated_at"] is not None
            and r["batch_no"] <= context["batch_no"] and r["updated_at"] <= context["as_of"]]
    return newest(seen, ["order_id"], ["event_id"])


def layer(expected, actual):
    return against(expected, actual, ["order_id"], RECORD)


def lineage(t):
    def unknown(row):
        return row is None or row["execution_status"] == "UNKNOWN"

    activities = t["cloud_activities"]
    runs = {r["run_id"] for r in t["cloud_runs"] if r["run_id"] is not None}
    bad = sum(unknown(run) or unknown(a) or None in take(a, ("source_dataset", "target_dataset"))
              for a, run in left_join(activities, t["cloud_runs"], ["run_id"], ["run_id"]))
    waiting = [a for a in activities if a["dependency_id"] is not None]
    unmet = sum(d is None or d["execution_status"] != "SUCCESS"
                for _, d in left_join(waiting, activities, ["dependency_id", "run_id"], ["activity_id", "run_id"]))
    return bad + unmet + sum(r["run_id"] not in runs for r in t["cloud_target"])


def copies(t):
    publishing = [a for a in t["cloud_activities"] if a["target_dataset"] == "target"]
    right = ("SUCCESS", len(visible(t)), len(t["cloud_target"]))
    wrong = sum(take(a, ("execution_status", "rows_read", "rows_written")) != right for a in publishing)
    return layer(visible(t), t["cloud_target"]) + wrong + (not publishing)


def publication(t):
    steps = newest(t["cloud_steps"], [], ["step_no"])
    done = steps and take(steps[0], ("execution_status", "batch_no")) == ("SUCCESS", t["cloud_context"][0]["batch_no"])
    failed = sum(a["execution_status"] != "SUCCESS" for a in t["cloud_activities"])
    return layer(visible(t), t["cloud_target"]) + failed + (not done)


def references(t):
    keys, clock = ["dataset_id", "reference_id"], t["cloud_context"][0]["as_of"]
    count = full_join(t["cloud_required_references"], t["cloud_references"], keys)
    for need, seen in inner_join(t["cloud_required_references"], t["cloud_references"], keys):
        at, sla = seen["observed_at"], need["sla_minutes"]
        count += at is None or at > clock or sla is not None and clock - at > timedelta(minutes=sla)
    return count


def access(t):
    clock = t["cloud_context"][0]["as_of"]
    seen = [{**r, "good": r["outcome"] == "ALLOWED" and r["observed_at"] is not None and r["observed_at"] <= clock} for r in t["az_access"]]
    needed = [{**r, "good": True} for r in t["az_required_access"]]
    return against(needed, seen, ["observation_id"], ["identity_id", "scope", "operation", "good"])


def contract(expected, observed, keys, fields):
    return lambda t: against(t[expected], t[observed], keys, fields)


MODELS = {
    "C01": missing_and_unexpected,
    "C02": lambda t: sum(r["customer_id"] is not None and r["customer_id"] <= 0 for r in t["target_orders"]),
    "C03": lambda t: sum(r["net_amount"] is None for r in t["target_orders"]),
    "C04": lambda t: repeated(t["target_orders"], ["order_id"]),
    "C05": wrong_net,
    "C06": capstone,
    "C07": lambda t: full_join(totals_by(t["order_lines"], "order_id", "net_amount"), t["target_order_totals"], ["order_id"], ["net_amount"]),
    "C08": lambda t: full_join(newest(t["source_order_events"], ["order_id"], ["updated_at", "event_id"]), t["target_current_orders"],
                               ["order_id"], ["event_id", "updated_at", "net_amount"]),
    "C09": lambda t: full_join(per_day(t["source_time_orders"]), t["target_utc_daily"], ["order_date"], ["order_count", "net_revenue"]),
    "C10": lambda t: against(newest(arrived(t), ["order_id"], ["event_at", "event_id"]), t["incremental_target"],
                             ["order_id"], ["event_id", "event_at", "net_amount"]),
    "C11": not_fresh,
    "C12": lambda t: full_join(newest(t["source_customer_changes"], ["customer_id"], ["effective_at", "event_id"]),
                               t["target_customers_current"], ["customer_id"], ["tier", "effective_at", "event_id"]),
    "C13": type2,
    "C14": lambda t: full_join(mapped(t), t["etl_target"], ["order_id"], ["customer_id"]),
    "C15": amounts,
    "C16": quarantine,
    "C17": replayed,
    "C18": lambda t: amounts(t) + last_steps_problem(t),
    "C23": lineage,
    "C24": contract("cloud_expected_schema", "cloud_schema", ["dataset", "column_name"], ["data_type"]),
    "C25": lambda t: layer(visible(t), t["cloud_bronze"]) + layer(t["cloud_bronze"], t["cloud_silver"]) + layer(t["cloud_silver"], t["cloud_target"]),
    "C26": copies,
    "C27": lambda t: layer(visible(t), t["cloud_target"]),
    "C28": publication,
    "C29": lambda t: full_join(t["cloud_expected_partitions"], totals_by(t["cloud_manifest"], "partition_key", "row_count"),
                               ["partition_key"], ["row_count"]) + repeated(t["cloud_manifest"], ["file_key"]),
    "C30": references,
    "C31": contract("db_contract", "db_publication", ["record_id"], ["classification", "amount"]),
    "C32": contract("db_expected_after", "db_after", ["order_id"], ["version", "amount", "updated_at"]),
    "C33": contract("sy_expected_fact", "sy_fact", ["sale_id"], ["customer_key", "amount", "sale_date"]),
    "C34": contract("sy_expected_report", "sy_report", ["sale_date", "region"], ["sale_count", "total"]),
    "C35": contract("az_expected_files", "az_files", ["file_id"], ["path", "route", "byte_count"]),
    "C36": access,
}
