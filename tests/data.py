"""Hand-made input with the edge rows of the input contract."""

from tests.conftest import write_lines

TRANSACTION_HEADER = (
    "transaction_id,store_id,payment_method_id,voucher_id,user_id,"
    "original_amount,discount_applied,final_amount,created_at"
)
ITEM_HEADER = "transaction_id,item_id,quantity,unit_price,subtotal,created_at"
MENU_HEADER = "item_id,item_name,category,price,is_seasonal,available_from,available_to"
USER_HEADER = "user_id,gender,birthdate,registered_at"


def transaction(tid, store, user, amount, created, voucher=""):
    return f"{tid},{store},1,{voucher},{user},{amount},0.0,{amount},{created}"


TRANSACTIONS_JAN = [
    transaction("early", 1, "10.0", "80.0", "2024-01-05 05:59:59"),
    transaction("open", 1, "10.0", "80.0", "2024-01-05 06:00:00", voucher="7.0"),
    transaction("close", 1, "10", "75.0", "2024-01-05 22:59:59"),
    transaction("late", 1, "11", "80.0", "2024-01-05 23:00:00"),
    transaction("cheap", 1, "11", "74.99", "2024-01-05 12:00:00"),
    transaction("nan", 1, "11", "nan", "2024-01-05 12:00:00"),
    transaction("noamount", 2, "", "", "2024-01-05 12:00:00"),
    transaction("abc", 2, "12", "abc", "2024-01-05 12:00:00"),
    transaction("java", 2, "12", "99d", "2024-01-05 12:00:00"),
    transaction("unpadded", 2, "12", "100", "2024-1-5 7:03:00"),
    transaction("zero", 2, "13", "0", "2024-01-05 12:00:00"),
    transaction("minus", 2, "14", "-5", "2024-01-05 12:00:00"),
    transaction("baddate", 2, "15", "90", "2024-13-05 12:00:00"),
    transaction("dateonly", 2, "15", "90", "2024-01-05"),
    "short,3,1",
    transaction("long", 3, "16", "200.5", "2024-01-06 10:00:00") + ",surplus",
    transaction("nostore", "", "17", "10", "2024-01-06 10:00:00"),
]
TRANSACTIONS_JUN = [
    transaction("june", 1, "10.0", "1.5", "2024-06-30 22:00:00"),
    transaction("july", 1, "10.0", "2.5", "2024-07-01 06:00:00"),
    transaction("old", 1, "10.0", "500", "2023-12-31 22:59:59"),
    transaction("newyear", 1, "12.0", "500", "2024-01-01 00:00:00"),
    transaction("future", 1, "10.0", "500", "2026-01-01 00:00:00"),
    transaction("tie3", 9, "3", "20", "2025-03-01 10:00:00"),
    transaction("tie1", 9, "1", "20", "2025-03-01 10:00:00"),
    transaction("tie4", 9, "4", "20", "2025-03-01 10:00:00"),
    transaction("tie2", 9, "2", "20", "2025-03-01 10:00:00"),
]
ITEMS = [
    "t1,5,1,10.0,10.0,2024-01-05 10:00:00",
    "t1,5,3,10.0,30.0,2024-01-06 10:00:00",
    "t2,6,1,10.0,40.0,2024-01-07 10:00:00",
    "t2,6,1,10.0,0.5,2024-01-07 10:00:00",
    "t3,99,1,500.0,500.0,2024-02-07 10:00:00",
    "t4,5,1,10.0,bad,2024-02-07 10:00:00",
    "t4,5,1,10.0,10.0,not a date",
    "t5,5,1,10.0,10.0,2023-02-07 10:00:00",
    "t6,7,1,0.1,0.1,2025-03-01 10:00:00",
    "t6,7,1,0.2,0.2,2025-03-01 10:00:00",
    "t6,5,1,0.3,0.3,2025-04-01 10:00:00",
]
MENU = [
    "5,Cortado,coffee,3.5,False,,",
    "6,Old name,coffee,3.5,False,,",
    "7,Tea,tea,2.0,True,2024-01-01,2024-03-01",
    "6,Oat Mocha,coffee,3.5,False,,",
]
USERS_JAN = [
    "1,female,1971-11-30,2023-06-12 17:25:41",
    "3,female,1990-01-01,2023-06-12 17:25:41",
    "10,male,1980-02-03,2023-06-12 17:25:41",
]
USERS_FEB = ["3,female,1992-03-17,2023-08-19 11:02:36", "12,female,1999-09-09,2023-08-19 11:02:36"]


def write_client(root):
    write_lines(f"{root}/transactions_202401.csv", TRANSACTION_HEADER, TRANSACTIONS_JAN)
    write_lines(f"{root}/transactions_202406.csv", TRANSACTION_HEADER, TRANSACTIONS_JUN)
    write_lines(f"{root}/transaction_items_202401.csv", ITEM_HEADER, ITEMS)
    write_lines(f"{root}/menu_items.csv", MENU_HEADER, MENU)
    write_lines(f"{root}/users_202401.csv", USER_HEADER, USERS_JAN)
    write_lines(f"{root}/users_202402.csv", USER_HEADER, USERS_FEB)
    return str(root)


def write_clients(root, *clients):
    for client in clients:
        write_client(f"{root}/client_id={client}")
    return str(root)


# Expected answers, worked out by hand from the rows above.
Q1_IDS = {"open", "close", "unpadded", "long"}
Q2 = [
    (2024, 1, 5, "Cortado", 2, 6, "Oat Mocha", 40.5),
    (2024, 2, 99, "Unknown", 1, 99, "Unknown", 500.0),
    (2025, 3, 7, "Tea", 2, 7, "Tea", 0.3),
    (2025, 4, 5, "Cortado", 1, 5, "Cortado", 0.3),
]
Q3 = [
    (2024, 1, None, 10.0),
    (2024, 1, "1", 80.0 + 75.0 + 74.99 + 1.5),
    (2024, 1, "2", 100.0),
    (2024, 1, "3", 200.5),
    (2025, 1, "9", 80.0),
]
Q4 = [
    ("1", 10, 5, "1980-02-03"),
    ("1", 11, 3, None),
    ("1", 12, 1, "1999-09-09"),
    ("2", 12, 3, "1999-09-09"),
    ("2", 13, 1, None),
    ("2", 14, 1, None),
    ("3", 16, 1, None),
    ("9", 4, 1, None),
    ("9", 3, 1, "1992-03-17"),
    ("9", 2, 1, None),
]
Q2B = [
    ("top_profit", 2024, "2024-2", "Unknown", 500.0),
    ("top_profit", 2025, "2025-3", "Tea", 0.3),
    ("top_selling", 2024, "2024-1", "Cortado", 2.0),
    ("top_selling", 2025, "2025-3", "Tea", 2.0),
]
