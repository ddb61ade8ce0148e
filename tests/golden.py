"""The small input files whose results are known by hand."""

EMPLOYEES = """\
id,name,age,city,salary
1,Alice,30,New York,75000.50
2,Bob,25,San Francisco,85000.75
3,Charlie,35,Seattle,95000.00
4,Diana,28,Boston,70000.25
5,Eve,32,Austin,80000.00
6,Frank,29,Denver,72000.00
7,Grace,31,Miami,78000.50
8,Henry,27,Portland,69000.75
9,Iris,33,Chicago,88000.00
10,Jack,26,Phoenix,71000.25
"""

PRODUCTS = """\
product_id,product_name,category,price,stock_quantity,supplier
P001,Laptop,Electronics,1299.99,45,TechSupplier Inc
P002,Office Chair,Furniture,249.99,120,ComfortSeating
P003,Notebook,Stationery,3.99,500,PaperGoods Ltd
P004,Wireless Mouse,Electronics,29.99,200,TechSupplier Inc
P005,Desk Lamp,Furniture,39.99,80,LightingCo
P006,USB Cable,Electronics,9.99,350,TechSupplier Inc
P007,Whiteboard,Office,89.99,25,OfficeMax
P008,Coffee Mug,Kitchen,12.99,150,KitchenWare
P009,Monitor,Electronics,349.99,60,TechSupplier Inc
P010,Desk Organizer,Office,24.99,95,OfficeMax
P011,Keyboard,Electronics,79.99,110,TechSupplier Inc
P012,Filing Cabinet,Furniture,189.99,30,OfficeFurniture Co
P013,Pen Set,Stationery,14.99,300,PaperGoods Ltd
P014,Desk Mat,Office,19.99,180,OfficeMax
P015,Water Bottle,Kitchen,15.99,220,KitchenWare
"""

USERS = """\
user_id,name,age,department,salary,join_date
U001,Alice Johnson,28,Engineering,95000,2022-03-15
U002,Bob Smith,35,Marketing,78000,2020-06-01
U003,Charlie Brown,42,Engineering,105000,2019-01-10
U004,Diana Prince,31,HR,72000,2021-08-20
U005,Edward Norton,29,Engineering,88000,2022-11-05
U006,Fiona Apple,38,Sales,82000,2020-02-14
U007,George Lucas,45,Management,120000,2018-05-30
U008,Hannah Montana,26,Marketing,68000,2023-01-12
"""
