"""Fixed values that must equal the reference's for identical results.

Everything here is data, kept together and in the reference's natural order. Conditions are
SQL expression text valid in both Spark SQL and DuckDB, so the same rule drives the Spark
column (``F.expr``) and the oracle query.
"""

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — alert thresholds and fraud rules (evaluation order matters: first match wins)
# ---------------------------------------------------------------------------------------------
HIGH_VALUE_THRESHOLD = 12999

SUSPICIOUS_RULES = [
    ("order_amount >= 25000",
     "Very high order amount exceeds 25K INR"),
    ("payment_status = 'FAILED' AND order_amount >= 5000",
     "Failed payment on high-value order"),
    ("payment_method = 'COD' AND order_amount >= 8999",
     "High-value COD order risk"),
    ("payment_status = 'FAILED' AND device_type = 'WEB' AND order_amount >= 2999",
     "Suspicious failed web payment"),
]

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — generator value lists with slot weights (values in the reference's order)
# ---------------------------------------------------------------------------------------------
ORDER_AMOUNTS = ["275", "299", "349", "399", "549", "899", "1175", "1299", "1499", "2999",
                 "3499", "4499", "5999", "8999", "8999", "24999", "54999", "69999", "79999",
                 "114999"]
PAYMENT_STATUS_OPTIONS = ["SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS",
                          "SUCCESS", "SUCCESS", "SUCCESS", "FAILED", "FAILED", "PENDING"]
ORDER_STATUS_OPTIONS = ["PLACED", "PLACED", "PLACED", "PLACED", "PLACED", "SHIPPED", "SHIPPED",
                        "DELIVERED", "DELIVERED", "CANCELLED"]
PAYMENT_METHOD_OPTIONS = ["UPI", "UPI", "UPI", "UPI", "UPI", "UPI", "UPI", "UPI", "CARD", "CARD",
                          "CARD", "CARD", "WALLET", "WALLET", "WALLET", "COD", "COD", "COD",
                          "NETBANKING", "NETBANKING"]
DEVICE_TYPE_OPTIONS = ["ANDROID", "ANDROID", "ANDROID", "ANDROID", "ANDROID", "ANDROID", "WEB",
                       "WEB", "IOS", "IOS"]
ORDER_CITY_OPTIONS = ["Mumbai", "Mumbai", "Mumbai", "Mumbai", "Delhi", "Delhi", "Delhi", "Delhi",
                      "Bengaluru", "Bengaluru", "Bengaluru", "Pune", "Pune", "Hyderabad",
                      "Hyderabad", "Chennai", "Chennai", "Ahmedabad", "Ahmedabad", "Kolkata"]
EVENT_TIME_MAX_AGE_SECONDS = 15
QUANTITY_RANGE = (1, 3)



def weights(options: list[str]) -> list[tuple[str, int]]:
    """(value, count) in first-appearance order: the slot table of an option list."""
    out: dict[str, int] = {}
    for o in options:
        out[o] = out.get(o, 0) + 1
    return list(out.items())


PAYMENT_STATUS = weights(PAYMENT_STATUS_OPTIONS)
ORDER_STATUS = weights(ORDER_STATUS_OPTIONS)
PAYMENT_METHOD = weights(PAYMENT_METHOD_OPTIONS)
DEVICE_TYPE = weights(DEVICE_TYPE_OPTIONS)
ORDER_CITY = weights(ORDER_CITY_OPTIONS)

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — customer seed generator weights
# ---------------------------------------------------------------------------------------------
CUSTOMER_CITY = [("Mumbai", "West", 20), ("Delhi", "North", 18), ("Bengaluru", "South", 15),
                 ("Pune", "West", 10), ("Hyderabad", "South", 10), ("Chennai", "South", 10),
                 ("Ahmedabad", "West", 9), ("Kolkata", "East", 8)]
LOYALTY_TIER = [("BRONZE", 40), ("SILVER", 30), ("GOLD", 20), ("PLATINUM", 10)]
# signup age in days, inclusive range, per tier
SIGNUP_AGE_DAYS = {"PLATINUM": (700, 900), "GOLD": (500, 750), "SILVER": (300, 550),
                   "BRONZE": (60, 350)}
FIRST_NAMES_MALE = [
    "Aarav", "Rahul", "Amit", "Vikram", "Rohit", "Arjun", "Saurabh",
    "Nikhil", "Karthik", "Rajesh", "Aditya", "Harsh", "Manish", "Pranav",
    "Siddharth", "Vivek", "Gaurav", "Abhishek", "Dhruv", "Yash",
    "Rohan", "Kunal", "Ankit", "Varun", "Ishaan",
]
FIRST_NAMES_FEMALE = [
    "Priya", "Sneha", "Deepika", "Ananya", "Meera", "Kavitha", "Pooja",
    "Ritu", "Neha", "Simran", "Divya", "Shruti", "Nisha", "Tanvi",
    "Aisha", "Swati", "Jyoti", "Pallavi", "Radhika", "Megha",
    "Kriti", "Aditi", "Isha", "Sakshi", "Trisha",
]
LAST_NAMES = {
    "North": ["Sharma", "Verma", "Kumar", "Singh", "Gupta", "Agarwal",
              "Saxena", "Kaur", "Mehta", "Kapoor", "Malhotra", "Bhatia"],
    "South": ["Nair", "Iyer", "Reddy", "Rao", "Menon", "Pillai",
              "Krishnan", "Subramanian", "Naidu", "Hegde"],
    "West": ["Patel", "Joshi", "Deshmukh", "Jain", "Shah", "Parekh",
             "Kulkarni", "Patil", "Deshpande", "Thakkar"],
    "East": ["Banerjee", "Mukherjee", "Das", "Sen", "Bose", "Roy",
             "Chatterjee", "Ghosh"],
}
# seed catalog: sku, name, category, brand, price, inventory range (inclusive)
PRODUCTS = [
    ("SKU-ELEC-1001", "iPhone 15 Pro 128GB", "electronics", "Apple", 79999.00, (60, 100)),
    ("SKU-ELEC-1002", "Samsung Galaxy S24 Ultra", "electronics", "Samsung", 69999.00, (80, 150)),
    ("SKU-ELEC-1003", "Sony WH-1000XM5 Headphones", "electronics", "Sony", 24999.00, (120, 200)),
    ("SKU-ELEC-1004", "MacBook Air M3 13-inch", "electronics", "Apple", 114999.00, (30, 60)),
    ("SKU-ELEC-1005", "iPad Air 5th Gen 64GB", "electronics", "Apple", 54999.00, (70, 120)),
    ("SKU-ELEC-1006", "JBL Flip 6 Bluetooth Speaker", "electronics", "JBL", 8999.00, (180, 250)),
    ("SKU-FASH-2001", "Levis 501 Original Fit Jeans", "fashion", "Levis", 3499.00, (250, 400)),
    ("SKU-FASH-2002", "Nike Air Max 270 Running Shoes", "fashion", "Nike", 8999.00, (180, 280)),
    ("SKU-FASH-2003", "Allen Solly Slim Fit Formal Shirt", "fashion", "Allen Solly", 1499.00, (400, 550)),
    ("SKU-FASH-2004", "Zara Pleated Midi Dress", "fashion", "Zara", 2999.00, (150, 230)),
    ("SKU-FASH-2005", "Ray-Ban Aviator Classic Sunglasses", "fashion", "Ray-Ban", 5999.00, (250, 370)),
    ("SKU-FASH-2006", "Woodland Trekking Boots", "fashion", "Woodland", 4499.00, (200, 300)),
    ("SKU-GROC-3001", "Tata Tea Premium 1kg", "grocery", "Tata", 399.00, (2000, 3000)),
    ("SKU-GROC-3002", "Aashirvaad Superior MP Atta 10kg", "grocery", "Aashirvaad", 549.00, (1500, 2200)),
    ("SKU-GROC-3003", "Fortune Rice Bran Oil 5L", "grocery", "Fortune", 899.00, (1000, 1500)),
    ("SKU-GROC-3004", "Maggi 2-Minute Noodles Family Pack", "grocery", "Nestle", 299.00, (3000, 4000)),
    ("SKU-GROC-3005", "Amul Butter 500g", "grocery", "Amul", 275.00, (3500, 5000)),
    ("SKU-BOOK-4001", "Atomic Habits by James Clear", "books", "Penguin", 399.00, (350, 550)),
    ("SKU-BOOK-4002", "The Psychology of Money", "books", "Jaico", 349.00, (300, 450)),
    ("SKU-BOOK-4003", "Ikigai The Japanese Secret", "books", "Penguin", 299.00, (400, 600)),
    ("SKU-BOOK-4004", "Rich Dad Poor Dad", "books", "Plata", 399.00, (350, 500)),
    ("SKU-BOOK-4005", "Sapiens A Brief History", "books", "Vintage", 499.00, (250, 380)),
    ("SKU-BEAU-5001", "Lakme Eyeconic Kajal Deep Black", "beauty", "Lakme", 249.00, (700, 1000)),
    ("SKU-BEAU-5002", "Nivea Cocoa Nourish Body Lotion", "beauty", "Nivea", 399.00, (900, 1300)),
    ("SKU-BEAU-5003", "Philips BT3211 Beard Trimmer", "beauty", "Philips", 1299.00, (400, 650)),
    ("SKU-BEAU-5004", "Forest Essentials Soundarya Wash", "beauty", "Forest Essentials", 1175.00, (550, 800)),
    ("SKU-SPRT-6001", "Yonex Nanoray Light 18i Racket", "sports", "Yonex", 2999.00, (140, 220)),
    ("SKU-SPRT-6002", "Nike Premier League Flight Football", "sports", "Nike", 1499.00, (200, 300)),
    ("SKU-SPRT-6003", "Boldfit Resistance Bands Set", "sports", "Boldfit", 599.00, (350, 500)),
    ("SKU-SPRT-6004", "Strauss Premium Yoga Mat 6mm", "sports", "Strauss", 899.00, (280, 400)),
]
CUSTOMER_UPDATED_TIME = "10:30:00"   # updated_at = signup date at this time of day
PRODUCT_UPDATED_AT = "2024-01-01 00:00:00"
# business order of tiers on dashboards (highest first)
TIER_ORDER = ["PLATINUM", "GOLD", "SILVER", "BRONZE"]

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — data-quality rules (table order = reporting order; first failing rule wins)
# ---------------------------------------------------------------------------------------------
VALID_PAYMENT_STATUS = ["SUCCESS", "FAILED", "PENDING"]
QUANTITY_CLAMP = (1, 100)
MAX_EVENT_AGE = "1 day"

# ---------------------------------------------------------------------------------------------
# FIXED VALUES — KPI keys, SLOs, burn-rate thresholds, storage policy
# ---------------------------------------------------------------------------------------------
KPI_KEYS = ["total_orders_1min", "total_revenue_1min", "failed_payments_1min",
            "avg_order_value_1min", "events_per_second"]
FAILED_RATE_ALERT = 0.25          # failed/total above this ...
FAILED_RATE_ALERT_WINDOWS = 2     # ... for 10 minutes = two 5-minute windows
SPIKE_FACTOR = 3.0                # suspicious count above 3x baseline
SPIKE_BASELINE_WINDOWS = 12       # ours: the reference leaves the baseline undefined
# name, objective (seconds; failed_batches: 1 for a failed batch, else 0, none may fail),
# fast-burn bad share over 1 h, slow-burn bad share over 6 h (None: no such alert)
SLO_BURN = [
    ("ingestion_latency", 5.0, 0.02, 0.005),
    ("failed_batches", 0.5, 0.0, None),
    ("query_latency", 3.0, 0.05, 0.02),
    ("processing_lag", 60.0, 0.10, 0.05),
    ("data_freshness", 10.0, 0.10, 0.05),
]
SLO_PERCENTILE = 0.95
RUN_MIN_THROUGHPUT = 4500         # events/s for a passing load run
RUN_MIN_ENRICHED_RATIO = 0.95
RETENTION_DAYS = 7
