"""Names, labels, statuses and numbers that results depend on."""

# Fixed values -- calendar labels, ISO order (Monday = 1).
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAY_NAMES = (
    "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo",
)
WEEKEND_DAYS = (6, 7)

# Fixed values -- defaults for missing source values.
DEFAULT_ZONE = "Sin zona"
DEFAULT_CATEGORY = "sin_categoria"
UNKNOWN_STATUS = "unknown"

# Fixed values -- order statuses that count as a sale or can be delivered.
SOLD_IN_STAR = ("confirmed",)
SOLD_IN_SALES = ("completed",)
ROUTABLE_STATUSES = ("completed", "pending", "in_progress")

# Fixed values -- delivery.
DEPOT_ID = "loc-central"
DEPOT_NAME = "Centro de distribución"
DEPOT_LATITUDE = 9.9326
DEPOT_LONGITUDE = -84.0796
EARTH_RADIUS_KM = 6371.0
COURIER_KMH = 25.0
COURIER_PREFIX = "courier-"
LOCATION_PREFIX = "loc-"
DELIVERY_NAME_PREFIX = "Entrega "
SMALL_FLEET = 2

# Stops of one delivery shift; the fleet grows with the orders.
STOPS_PER_COURIER = 40
# A shift ends where no order follows for so long.
SHIFT_GAP = "2 hours"

# Fixed values -- graph query limits.
MAX_PATH_HOPS = 8
SAMPLE_PATH_HOPS = 5

# Fixed values -- shape of generated transactions.
SEED_STATUSES = ("pending", "confirmed", "cancelled")
SEED_STATUS_WEIGHTS = (0.10, 0.75, 0.15)
SEED_PICKUP_SHARE = 0.3
SEED_MAX_ITEMS = 4
SEED_MAX_QUANTITY = 3
SEED_MAX_PARTY = 8
SEED_DAYS_BACK = 180
SEED_MAX_LEAD_HOURS = 48
SEED_REFERRED_SHARE = 0.5
