"""Small hand-made deliveries in CSV form, and writing them to a folder."""

from __future__ import annotations

from pathlib import Path

from martloom.sources.csv_files import read_folder

SALES = """\
TransactionID,Date,StoreID,ProductID,Quantity,UnitPrice,DiscountAmount,TotalSales,PromotionID
A1,2024-02-27,10,P1,2,3.50,0.00,7.00,
A2,2024-02-27,10,P2,1,20.00,5.00,15.00,SPRING
A3,2024-02-28,20,P1,4,3.50,1.00,13.00,SPRING
A4,2024-03-01,20,P3,1,8.10,0.00,8.10,GONE
A5,2024-03-01,77,P1,1,3.50,0.00,3.50,FREE
A6,,10,P1,1,3.50,0.00,3.50,
A7,2024-03-05,10,P1,1,3.50,3.50,0.00,
,2024-03-06,10,P1,1,3.50,0.00,3.50,
"""
PRODUCTS = """\
ProductID,Category,Brand,ProductName,BasePrice
P1,Food,Acre,Bread,3.50
P2,Garden,Root,Spade,20.00
P3,Garden,Root,,8.10
"""
STORES = """\
StoreID,StoreName,Region,StoreType,SquareFootage
10,Harbour,North,Small,900
20,Hill,South,Large,2500
30,Closed,South,Large,0
"""
PROMOTIONS = """\
PromotionID,PromotionType,StartDate,EndDate,DiscountPercent,ProductID,MarketingSpend
SPRING,Season,2024-02-01,2024-03-31,10,P2,250
FREE,Gift,2024-01-01,2024-12-31,5,P1,0
OPEN,Gift,2024-01-01,,5,P1,100
"""


def write(folder: Path, **texts: str) -> str:
    whole = {"sales": SALES, "products": PRODUCTS, "stores": STORES, "promotions": PROMOTIONS} | texts
    folder.mkdir(parents=True, exist_ok=True)
    for entity, text in whole.items():
        (folder / f"{entity}.csv").write_text(text)
    return str(folder)


def deliver(spark, folder: Path, **texts: str):
    return read_folder(spark, write(folder, **texts))
