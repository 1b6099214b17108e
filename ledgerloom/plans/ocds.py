"""The contract of the procurement archive: its 22 tables, their grains, typed columns and treatments."""

from __future__ import annotations

from .silver import Classification, Contract

# Names of the published archive, its typed columns, and the tables that each treatment applies to.
_R = "compiledRelease/"
_TEN, _AWA, _CON = _R + "tender/", _R + "awards/0/", _R + "contracts/0/"
INTEGERS = frozenset([_TEN + "numberOfTenderers", _TEN + "enquiryPeriod/durationInDays", _TEN + "items/0/position", _AWA + "items/0/position", _CON + "period/durationInDays", _CON + "items/0/position"])
BOOLEANS = frozenset([_TEN + "hasTenderInformationProtectedByLaw"])
DATETIMES = frozenset([_R + "date", _R + "publishedDate", "releases/0/date"])
#: Archive member: (typed table, grain beside ocid).
TABLES = {
    "records.csv": ("procurement_process", []),
    "releases.csv": ("release_history", ["releases/0/details/id"]),
    "com_sources.csv": ("process_source", [_R + "sources/0/id"]),
    "com_parties.csv": ("party", [_R + "parties/0/id"]),
    "com_par_additionalIdentifiers.csv": ("party_additional_identifier", [_R + "parties/0/id", _R + "parties/0/additionalIdentifiers/0/id", _R + "parties/0/additionalIdentifiers/0/scheme"]),
    "com_ten_tenderers.csv": ("tenderer", [_TEN + "tenderers/0/id"]),
    "com_ten_documents.csv": ("tender_document", [_TEN + "documents/0/id"]),
    "com_ten_items.csv": ("tender_item", [_TEN + "items/0/id"]),
    "com_ten_ite_additionalClassific.csv": ("tender_item_classification", [_TEN + "items/0/id", _TEN + "items/0/additionalClassifications/0/id"]),
    "com_ten_ite_tot_exchangeRates.csv": ("tender_item_exchange_rate", [_TEN + "items/0/id", _TEN + "items/0/totalValue/exchangeRates/0/currency"]),
    "com_awards.csv": ("award", [_AWA + "id"]),
    "com_awa_suppliers.csv": ("award_supplier", [_AWA + "id", _AWA + "suppliers/0/id"]),
    "com_awa_items.csv": ("award_item", [_AWA + "id", _AWA + "items/0/id"]),
    "com_awa_ite_additionalClassific.csv": ("award_item_classification", [_AWA + "id", _AWA + "items/0/id", _AWA + "items/0/additionalClassifications/0/id"]),
    "com_awa_ite_tot_exchangeRates.csv": ("award_item_exchange_rate", [_AWA + "id", _AWA + "items/0/id", _AWA + "items/0/totalValue/exchangeRates/0/currency"]),
    "com_awa_val_exchangeRates.csv": ("award_value_exchange_rate", [_AWA + "id", _AWA + "value/exchangeRates/0/currency"]),
    "com_contracts.csv": ("contract", [_CON + "id"]),
    "com_con_documents.csv": ("contract_document", [_CON + "id", _CON + "documents/0/id"]),
    "com_con_items.csv": ("contract_item", [_CON + "id", _CON + "items/0/id"]),
    "com_con_ite_additionalClassific.csv": ("contract_item_classification", [_CON + "id", _CON + "items/0/id", _CON + "items/0/additionalClassifications/0/id"]),
    "com_con_ite_tot_exchangeRates.csv": ("contract_item_exchange_rate", [_CON + "id", _CON + "items/0/id", _CON + "items/0/totalValue/exchangeRates/0/currency"]),
    "com_con_val_exchangeRates.csv": ("contract_value_exchange_rate", [_CON + "id", _CON + "value/exchangeRates/0/currency"]),
}
REPEATED = ("com_ten_ite_tot_exchangeRates.csv",)
CLASSIFIED = {
    "com_ten_items.csv": _TEN + "items/0/classification/",
    "com_ten_ite_additionalClassific.csv": _TEN + "items/0/additionalClassifications/0/",
    "com_awa_items.csv": _AWA + "items/0/classification/",
    "com_awa_ite_additionalClassific.csv": _AWA + "items/0/additionalClassifications/0/",
    "com_con_items.csv": _CON + "items/0/classification/",
    "com_con_ite_additionalClassific.csv": _CON + "items/0/additionalClassifications/0/",
}


def contract(member: str) -> Contract:
    part = CLASSIFIED.get(member)
    return Contract(
        grain=["ocid", *TABLES[member][1]], integers=INTEGERS, booleans=BOOLEANS, datetimes=DATETIMES, quarantine_duplicates=member in REPEATED,
        classification=Classification(part + "id", part + "description", part + "scheme") if part else None,
        identifier=(_R + "parties/0/identifier/scheme", _R + "parties/0/identifier/id", "dq_ruc_format_valid") if member == "com_parties.csv" else None,
        zero_flag=(_TEN + "value/amount", "dq_tender_value_is_zero") if member == "records.csv" else None,
        present_flag=(_CON + "implementation/finalValue/amount", "dq_final_value_available") if member == "com_contracts.csv" else None,
    )


CONTRACTS = {member: (output, contract(member)) for member, (output, _) in TABLES.items()}
