"""Declared schemas of the six sources, the control tables and the entities they form."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# Names and types of the source columns. Every column may be NULL.
_SOURCE_DDL = {
    "Orders": """
        OrderID int, CustomerID int, SalespersonPersonID int, PickedByPersonID int, ContactPersonID int,
        BackorderOrderID int, OrderDate date, ExpectedDeliveryDate date, CustomerPurchaseOrderNumber string,
        IsUndersupplyBackordered boolean, Comments string, DeliveryInstructions string, InternalComments string,
        PickingCompletedWhen timestamp, LastEditedBy int, LastEditedWhen timestamp""",
    "OrderLines": """
        OrderLineID int, OrderID int, StockItemID int, Description string, PackageTypeID int, Quantity int,
        UnitPrice decimal(18,2), TaxRate decimal(18,3), PickedQuantity int, PickingCompletedWhen timestamp,
        LastEditedBy int, LastEditedWhen timestamp""",
    "Customers": """
        CustomerID int, CustomerName string, BillToCustomerID int, CustomerCategoryID int, BuyingGroupID int,
        PrimaryContactPersonID int, AlternateContactPersonID int, DeliveryMethodID int, DeliveryCityID int,
        PostalCityID int, CreditLimit decimal(38,6), AccountOpenedDate date,
        StandardDiscountPercentage decimal(38,6), IsStatementSent boolean, IsOnCreditHold boolean, PaymentDays int,
        PhoneNumber string, FaxNumber string, DeliveryRun string, RunPosition string, WebsiteURL string,
        DeliveryAddressLine1 string, DeliveryAddressLine2 string, DeliveryPostalCode string,
        PostalAddressLine1 string, PostalAddressLine2 string, PostalPostalCode string, LastEditedBy int,
        ValidFrom timestamp, ValidTo timestamp""",
    "CustomerCategories": """
        CustomerCategoryID int, CustomerCategoryName string, LastEditedBy int, ValidFrom timestamp,
        ValidTo timestamp""",
    "StockItems": """
        StockItemID int, StockItemName string, SupplierID int, ColorID int, UnitPackageID int, OuterPackageID int,
        Brand string, Size string, LeadTimeDays int, QuantityPerOuter int, IsChillerStock boolean, Barcode string,
        TaxRate decimal(18,3), UnitPrice decimal(18,2), RecommendedRetailPrice decimal(18,2),
        TypicalWeightPerUnit decimal(18,3), MarketingComments string, InternalComments string, Photo binary,
        CustomFields string, Tags string, SearchDetails string, LastEditedBy int, ValidFrom timestamp,
        ValidTo timestamp""",
    "People": """
        PersonID int, FullName string, PreferredName string, SearchName string, IsPermittedToLogon boolean,
        LogonName string, IsExternalLogonProvider boolean, HashedPassword binary, IsSystemUser boolean,
        IsEmployee boolean, IsSalesperson boolean, UserPreferences string, PhoneNumber string, FaxNumber string,
        EmailAddress string, Photo binary, CustomFields string, OtherLanguages string, LastEditedBy int,
        ValidFrom timestamp, ValidTo timestamp""",
}

CONFIG_SCHEMA = (
    "config_id int NOT NULL, layer string NOT NULL, source_system string, source_schema string, source_table string, "
    "source_object string, load_type string, watermark_column string, business_key string, column_list string, "
    "is_active boolean"
)
WATERMARK_SCHEMA = (
    "timestamp timestamp NOT NULL, layer string NOT NULL, object_name string NOT NULL, key_1 string NOT NULL, "
    "key_1_desc string"
)


@dataclass(frozen=True)
class Source:
    """One source table and how it is loaded. ``unwanted`` columns stop at the raw layer; ``lookup_keys`` are
    keys of other sources by which its history is searched.
    """

    schema_name: str
    table: str
    business_key: str
    watermark: str | None = None
    unwanted: tuple[str, ...] = field(default=())
    lookup_keys: tuple[str, ...] = ()

    @property
    def object(self) -> str:
        return f"{self.schema_name}_{self.table}"

    @property
    def load_type(self) -> str:
        return "incremental" if self.watermark else "full"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(_SOURCE_DDL[self.table])


# The six sources, in config order.
SOURCE_SYSTEM = "WWI"
ORDERS = Source("Sales", "Orders", "OrderID", "LastEditedWhen", ("Comments", "DeliveryInstructions", "InternalComments"))
ORDER_LINES = Source("Sales", "OrderLines", "OrderLineID", "LastEditedWhen", lookup_keys=("OrderID",))
CUSTOMERS = Source("Sales", "Customers", "CustomerID", None, ("WebsiteURL", "DeliveryRun", "RunPosition"))
CUSTOMER_CATEGORIES = Source("Sales", "CustomerCategories", "CustomerCategoryID")
STOCK_ITEMS = Source("Warehouse", "StockItems", "StockItemID", None, ("MarketingComments", "InternalComments", "Photo"))
PEOPLE = Source("Application", "People", "PersonID", None, ("HashedPassword", "Photo", "CustomFields", "OtherLanguages"))
SOURCES = (ORDERS, ORDER_LINES, CUSTOMERS, CUSTOMER_CATEGORIES, STOCK_ITEMS, PEOPLE)


@dataclass(frozen=True)
class Dimension:
    """A dimension table: where its rows come from and how its history is kept."""

    name: str
    source: Source
    skey: str
    history: bool
    fact_key: str
    lookup: Source | None = None
    lookup_columns: tuple[str, ...] = ()
    refresh_source_on_fill: bool = True

    @property
    def key(self) -> str:
        return self.source.business_key


DIM_CUSTOMER = Dimension(
    "Dim_Customer", CUSTOMERS, "customer_skey", True, "CustomerID",
    CUSTOMER_CATEGORIES, ("CustomerCategoryName",), refresh_source_on_fill=False,
)
DIM_STOCK_ITEMS = Dimension("Dim_StockItems", STOCK_ITEMS, "stockitem_skey", True, "StockItemID")
DIM_PEOPLE = Dimension("Dim_People", PEOPLE, "person_skey", False, "SalespersonPersonID")
DIMENSIONS = (DIM_CUSTOMER, DIM_STOCK_ITEMS, DIM_PEOPLE)
FACT_SALES = "Fact_Sales"
DIM_DATE = "dim_date"
