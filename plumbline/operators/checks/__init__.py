"""The named checks. Each takes tables by name and returns counts and their sum."""

from plumbline.operators.checks import api, contract, etl, evidence, history, orders

CHECKS = {
    "C01": orders.key_completeness,
    "C02": orders.positive_customer,
    "C03": orders.net_present,
    "C04": orders.unique_orders,
    "C05": orders.net_calculation,
    "C06": orders.order_capstone,
    "C07": orders.join_grain,
    "C08": orders.latest_version,
    "C09": orders.utc_days,
    "C10": history.incremental_load,
    "C11": history.freshness,
    "C12": history.type1_customers,
    "C13": history.type2_customers,
    "C14": etl.mapping,
    "C15": etl.transform,
    "C16": etl.quarantine,
    "C17": etl.replay,
    "C18": etl.recovery,
    "C19": api.api_contract,
    "C20": api.api_pagination,
    "C21": api.api_retry,
    "C22": api.api_ingestion,
    "C23": evidence.lineage,
    "C24": evidence.schema_contract,
    "C25": evidence.layers,
    "C26": evidence.copy_metrics,
    "C27": evidence.watermark_load,
    "C28": evidence.publication_recovery,
    "C29": evidence.partition_manifest,
    "C30": evidence.reference_freshness,
    "C31": contract.classification_contract,
    "C32": contract.version_contract,
    "C33": contract.fact_contract,
    "C34": contract.report_contract,
    "C35": contract.file_contract,
    "C36": contract.access_contract,
}
