"""Codes, names and thresholds results depend on. No logic here."""

# Order statuses and the category each belongs to.
STATUS_COMPLETED = ["delivered"]
STATUS_IN_PROGRESS = ["shipped", "processing", "approved", "invoiced"]
STATUS_CANCELED = ["canceled", "unavailable"]

# State code -> name.
STATE_NAMES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AM": "Amazonas",
    "AP": "Amapá",
    "BA": "Bahia",
    "CE": "Ceará",
    "DF": "Distrito Federal",
    "ES": "Espírito Santo",
    "GO": "Goiás",
    "MA": "Maranhão",
    "MG": "Minas Gerais",
    "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso",
    "PA": "Pará",
    "PB": "Paraíba",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "PR": "Paraná",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RO": "Rondônia",
    "RR": "Roraima",
    "RS": "Rio Grande do Sul",
    "SC": "Santa Catarina",
    "SE": "Sergipe",
    "SP": "São Paulo",
    "TO": "Tocantins",
}

# State code -> region.
STATE_REGION = {
    "AC": "North",
    "AL": "Northeast",
    "AM": "North",
    "AP": "North",
    "BA": "Northeast",
    "CE": "Northeast",
    "DF": "Center-West",
    "ES": "Southeast",
    "GO": "Center-West",
    "MA": "Northeast",
    "MG": "Southeast",
    "MS": "Center-West",
    "MT": "Center-West",
    "PA": "North",
    "PB": "Northeast",
    "PE": "Northeast",
    "PI": "Northeast",
    "PR": "South",
    "RJ": "Southeast",
    "RN": "Northeast",
    "RO": "North",
    "RR": "North",
    "RS": "South",
    "SC": "South",
    "SE": "Northeast",
    "SP": "Southeast",
    "TO": "North",
}

# English category name -> category group.
CATEGORY_GROUP = {
    "auto": "auto",
    "baby": "lifestyle",
    "bed_bath_table": "home",
    "computers_accessories": "electronics",
    "food_drink": "food",
    "furniture_decor": "home",
    "health_beauty": "lifestyle",
    "housewares": "home",
    "perfumery": "lifestyle",
    "sports_leisure": "lifestyle",
    "stationery": "office",
    "telephony": "electronics",
    "toys": "lifestyle",
    "watches_gifts": "lifestyle",
}

# Category names of the product document -> English.
DOCUMENT_CATEGORY = {
    "agro_industria_e_comercio": "agro_industry",
    "artes": "arts",
    "automotivo": "automotive",
    "bebes": "baby",
    "beleza_saude": "beauty_health",
    "brinquedos": "toys",
    "cama_mesa_banho": "bed_bath_table",
    "casa_conforto": "home_comfort",
    "casa_construcao": "home_construction",
    "construcao_ferramentas_seguranca": "construction_tools",
    "cool_stuff": "cool_stuff",
    "eletrodomesticos": "appliances",
    "eletronicos": "electronics",
    "eletroportateis": "portable_appliances",
    "esporte_lazer": "sports_leisure",
    "fashion_bolsas_e_acessorios": "fashion_bags",
    "fashion_calcados": "fashion_shoes",
    "ferramentas_jardim": "garden_tools",
    "informatica_acessorios": "computers_accessories",
    "instrumentos_musicais": "musical_instruments",
    "malas_acessorios": "luggage_accessories",
    "moveis_decoracao": "furniture_decoration",
    "moveis_escritorio": "office_furniture",
    "papelaria": "stationery",
    "pcs": "computers",
    "perfumaria": "perfumery",
    "pet_shop": "pet_shop",
    "relogios_presentes": "watches_gifts",
    "telefonia": "telephony",
    "utilidades_domesticas": "household_utilities",
}

# Bucket edges and labels.
ORDER_SIZE = ([50.0, 200.0], ["small", "medium", "large"])
WEIGHT = ([500.0, 2000.0], ["light", "medium", "heavy"])
VOLUME = ([5000.0, 50000.0], ["small", "medium", "large"])
AOV_EDGES = [50.0, 100.0, 200.0, 500.0, 1000.0]
AOV_LABELS = ["R$0-50", "R$50-100", "R$100-200", "R$200-500", "R$500-1K", "R$1K+"]

# Holidays flagged by the date dimension.
HOLIDAYS = ["2016-01-01", "2016-12-25", "2017-01-01", "2017-12-25", "2018-01-01", "2018-12-25"]

PROFIT_RATE = 0.15

# Click stream vocabulary.
EVENT_TYPES = [
    "session_start",
    "page_view",
    "product_view",
    "search",
    "add_to_cart",
    "checkout_start",
    "checkout_complete",
]
FUNNEL_STAGES = ["session_start", "product_view", "add_to_cart", "checkout_start", "checkout_complete"]
IMPRESSION_EVENTS = ["session_start", "page_view", "product_view"]
CLICK_EVENTS = ["add_to_cart", "checkout_start"]
CONVERSION_EVENTS = ["order_placed", "checkout_complete"]
VARIANTS = ["control", "treatment"]

# Fields each topic must carry.
TOPIC_FIELDS = {
    "orders": ["event_type", "order_id", "customer_id", "timestamp"],
    "clickstream": ["event_type", "event_id", "session_id", "customer_id", "timestamp"],
    "payments": ["event_type", "order_id", "timestamp"],
    "deliveries": ["event_type", "order_id", "timestamp"],
    "reviews": ["event_type", "order_id", "product_id", "timestamp"],
}

# Stream settings.
WINDOW_SIZE = "5 minutes"
WINDOW_GRACE = "60 seconds"
SLA_DAYS = 3
SLA_CRITICAL_DAYS = 7
MIN_IMPRESSIONS = 5000
LAG_WARNING = 1000
LAG_CRITICAL = 5000

# Normal quantiles as the reports use them.
Z_95 = 1.959963984540054
Z_80_POWER = 0.8416212335729143
API_Z_ALPHA = 1.96
API_Z_BETA = 0.84

# Experiment catalog: id, name, metric, minimum lift %, test, planned n per arm, baseline rate.
EXPERIMENTS = [
    ("exp_001", "Free Shipping Threshold", "conversion_rate", 10.0, "chi_square", 2450, 0.12),
    ("exp_002", "Payment Installments (6 vs 12 months)", "conversion_rate_high_ticket", 15.0, "chi_square", 3200, 0.08),
    ("exp_003", "One-Page Checkout", "checkout_completion_rate", 8.0, "chi_square", 3500, 0.15),
    ("exp_004", "Review Solicitation Timing (3d vs 7d)", "review_rate", 20.0, "chi_square", 1800, 0.22),
    ("exp_005", "Product Recommendations (Personalized vs Popular)", "add_to_cart_rate", 12.0, "chi_square", 2700, 0.10),
    ("exp_006", "Delivery Speed Options (Standard vs Express)", "conversion_rate", 5.0, "chi_square", 6200, 0.14),
    ("exp_007", "Seller Ratings Display (Show vs Hide)", "conversion_rate_low_rated_sellers", 10.0, "chi_square", 2500, 0.11),
    ("exp_008", "Bundle Discounts (3 items for 10% off)", "items_per_order", 15.0, "t_test", 350, 0.25),
    ("exp_009", "Guest Checkout (Guest vs Forced Registration)", "conversion_rate", 15.0, "chi_square", 1900, 0.09),
    ("exp_010", "Dynamic Pricing (Demand-Based)", "revenue_per_order", 5.0, "t_test", 1200, 0.13),
]
EXPERIMENT_IDS = [e[0] for e in EXPERIMENTS]

# Priors of the sensitivity table.
PRIORS = [(1.0, 1.0), (0.5, 0.5), (10.0, 90.0), (100.0, 900.0)]

# Reason of a dead letter whose batch failed after all retries.
DLQ_RETRIES = "processing_failed_after_retries"
