"""Entities of the ERP: what a Bronze document holds and what its Silver table is, as data."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Field names of the source system, by type.
_HEADER_INT = "DocEntry DocNum SalesPersonCode PaymentGroupCode TransportationCode Series NumberOfInstallments"
_HEADER_STRING = "DocType CardCode CardName NumAtCard DocCurrency DocumentStatus Cancelled Comments Reference1"
_HEADER_DOUBLE = "DocTotal VatSum DiscountPercent DocRate"
_HEADER_DATE = "DocDate DocDueDate TaxDate CreationDate UpdateDate"
_LINE_INT = "LineNum BaseEntry BaseType"
_LINE_STRING = "ItemCode ItemDescription WarehouseCode AccountCode BarCode CFOPCode LineStatus FreeOfChargeBP ActualDeliveryDate"
_LINE_DOUBLE = "Quantity PriceAfterVAT LineTotal GrossProfit GrossBuyPrice"
_PARTNER_STRING = "CardCode CardName CardType Phone1 Phone2 Fax Cellular EmailAddress FederalTaxID Address ZipCode City County Country BillToState ShipToState Currency CardForeignName Valid Frozen Block FreeText"
_PARTNER_DOUBLE = "DiscountPercent CreditLimit MaxCommitment CurrentAccountBalance OpenDeliveryNotesBalance OpenOrdersBalance"
_ITEM_STRING = "ItemCode ItemName ForeignName BarCode VatLiable PurchaseItem SalesItem InventoryItem Mainsupplier Valid Frozen SalesUnit PurchaseUnit TreeType AssetItem"
_ITEM_DOUBLE = "DesiredInventory MinInventory QuantityOnStock QuantityOrderedFromVendors QuantityOrderedByCustomers CommissionPercent"
_VALIDITY = "ValidFrom ValidTo FrozenFrom FrozenTo"
_INVENTORY_HEADER = {"int": "DocEntry DocNum", "string": "DocType DocCurrency Comments JournalMemo", "double": "DocTotal", "date": "DocDate DocDueDate CreationDate UpdateDate"}
#: Names that a Silver column has instead of the source's.
_RENAMED = {"Price": "UnitPrice", "GrossTotal": "ValorTotalLinha", "BPL_IDAssignedToInvoice": "BranchId", "BPLName": "NomeFilial", "CostingCode": "CostCenter", "Currency@line": "LineCurrency", "DiscountPercent@line": "LineDiscountPercent", "SalesPersonCode@line": "LineSalesPersonCode", "ShipDate": "LineShipDate", "U_SX_Marca": "Marca"}
_TYPES = {"int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(), "date": T.DateType()}


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def _fields(line: bool = False, **names: str) -> list[tuple[str, str, str]]:
    """(source name, Silver name, type)."""
    out = []
    for kind, text in names.items():
        for n in text.split():
            out.append((n, snake(_RENAMED.get(f"{n}@line" if line else n, _RENAMED.get(n, n))), kind))
    return out


@dataclass(frozen=True)
class Entity:
    name: str
    key: tuple[str, ...]
    header: list[tuple[str, str, str]]
    lines: list[tuple[str, str, str]] = field(default_factory=list)
    history: bool = False  #: keeps versions (SCD2)
    masked: tuple[str, ...] = ()

    @property
    def source_schema(self) -> T.StructType:
        """Bronze JSON as strings where a value may be malformed; nothing is inferred."""
        raw = lambda fields: [T.StructField(s, T.StringType() if k == "date" else _TYPES[k]) for s, _, k in fields]
        fields = raw(self.header)
        if self.lines:
            fields += [T.StructField("DocumentLines", T.ArrayType(T.StructType(raw(self.lines)))), T.StructField("DocumentAdditionalExpenses", T.ArrayType(T.StructType([T.StructField("LineTotal", T.DoubleType())])))]
        return T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])


def _without(text: str, drop: str) -> str:
    return " ".join(x for x in text.split() if x not in drop.split())


_LINES_FULL = _fields(True, int=f"{_LINE_INT} SalesPersonCode", string=f"{_LINE_STRING} CostingCode Currency", double=f"{_LINE_DOUBLE} Price DiscountPercent GrossTotal", date="ShipDate")
_DOCUMENT = {"int": f"{_HEADER_INT} BPL_IDAssignedToInvoice", "string": _HEADER_STRING, "double": _HEADER_DOUBLE, "date": _HEADER_DATE}
_FACT = ("doc_entry", "line_num")

ENTITIES = {
    e.name: e
    for e in (
        Entity("invoices", _FACT, _fields(**_DOCUMENT | {"string": f"{_HEADER_STRING} BPLName"}), _LINES_FULL),
        Entity("orders", _FACT, _fields(**_DOCUMENT), [f for f in _LINES_FULL if f[0] != "GrossTotal"]),
        Entity(
            "quotations",
            _FACT,
            _fields(int=_without(_HEADER_INT, "PaymentGroupCode TransportationCode NumberOfInstallments"), string=_without(_HEADER_STRING, "Reference1"), double=_without(_HEADER_DOUBLE, "DocRate"), date=_HEADER_DATE),
            _fields(True, int=_LINE_INT, string=f"{_without(_LINE_STRING, 'AccountCode BarCode')} Currency", double=f"{_LINE_DOUBLE} Price DiscountPercent"),
        ),
        Entity("inventory_gen_entries", _FACT, _fields(**_INVENTORY_HEADER), _fields(True, int=_LINE_INT, string=f"{_without(_LINE_STRING, 'BarCode')} CostingCode", double="Quantity Price LineTotal GrossProfit GrossBuyPrice")),
        Entity(
            "business_partners",
            ("card_code",),
            _fields(string=_PARTNER_STRING, int="GroupCode SalesPersonCode PayTermsGrpCode PriceListNum", double=_PARTNER_DOUBLE, date=f"{_VALIDITY} CreateDate UpdateDate"),
            history=True,
            masked=("phone1", "phone2", "cellular", "federal_tax_id"),
        ),
        Entity("items", ("item_code",), _fields(string=f"{_ITEM_STRING} U_SX_Marca", int="ItemsGroupCode Manufacturer CommissionGroup", double=_ITEM_DOUBLE, date=_VALIDITY), history=True),
        Entity("item_groups", ("number",), _fields(int="Number", string="GroupName ProcurementMethod InventorySystem PlanningSystem ItemClass Alert RawMaterial")),
        Entity("sales_persons", ("sales_employee_code",), _fields(int="SalesEmployeeCode CommissionGroup EmployeeID", double="CommissionForSalesEmployee", string="SalesEmployeeName Remarks Locked Active Telephone Mobile Fax Email"), history=True, masked=("telephone", "mobile", "email")),
    )
}
