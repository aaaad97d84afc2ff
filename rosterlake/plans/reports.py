"""Header signatures and label codes of the delivered reports."""

from __future__ import annotations

from rosterlake.sources.landing import Signature

# Report headers in the order they are delivered.
PICKER_HEADER = (
    "КПП Комплектовщика", "employee_id", "ТК", "Дивизион", "Город", "Дата", "Имя комплектовщика",
    "Фамилия", "Организация", "Активное время, часов", "Кол-во включений", "Кол-во выключений",
    "Первое включение", "Последнее выключение", "Плановое начало смены", "Плановый конец смены",
    "Время последнего заказа", "Заказов собрано", "Заказано штук", "Собрано штук", "Заказано SKU",
    "Собрано SKU", "Заменено SKU", "Полнота сборки", "Утилизовано", "Заказов в час",
    "SLA, реакция", "SLA, сборка",
)
COURIER_HEADER = (
    "КПП Курьера", "employee_id", "ТК", "Дивизион", "Город", "Дата", "Транспорт", "Имя Курьера",
    "Фамилия", "Организация", "Активное время, часов", "Кол-во включений", "Кол-во выключений",
    "Первое включение", "Последнее выключение", "Плановое начало смены", "Плановый конец смены",
    "Время последнего заказа", "Заказов доставлено", "Утилизовано", "Пробег за день, км",
    "Заказов больше 20 кг", "Заказов 20-40 кг", "Заказов больше 40 кг", "Заказов в час",
    "SLA, доставка",
)
HOURS_HEADER = ("Подразделение", "Исполнитель", "Роль", "ID", "Город")
REVENUE_HEADER = (
    "ID", "Дата", "Сумма Выручки", "Статья", "Проект", "Регион", "Специальность", "Заметка",
)
REQUEST_HEADER = ("ТК", "Тип ресурса")
REQUEST_ALSO = ("Ночь", "Доп потребность")
PREFERENCE_HEADER = (
    "courier_id", "first_name", "last_name", "full_name", "phone", "type", "fraud",
    "delivery_provider_un_id", "delivery_provider_name", "delivery_service", "zones", "zone_ids",
    "couriers_zones_last_update", "day_of_week_number", "day_of_week", "time_start", "time_end",
    "time_interval", "couriers_intervals_last_update",
)
OUTPUT_HEADER = (
    "city", "delivery_provider", "delivery_service", "starting_point_id", "starting_point_name",
    "delivery_zone_id", "delivery_zone_name", "courier_un_id", "rider_name", "schedule_date",
    "start_time", "end_time", "horario_reparto_id", "free_float",
)

SIGNATURES = (
    Signature("pickers", PICKER_HEADER),
    Signature("couriers", COURIER_HEADER),
    Signature("hours", HOURS_HEADER),
    Signature("revenues", REVENUE_HEADER, exact=True),
    Signature("requests", REQUEST_HEADER, contains=REQUEST_ALSO),
    Signature("preferences", PREFERENCE_HEADER, exact=True),
    Signature("preferences", tuple(h for h in PREFERENCE_HEADER if h != "phone"), exact=True),
    Signature("outputs", OUTPUT_HEADER, exact=True),
)

# Label codes.
DIVISIONS = {
    "Волга": 1, "Санкт-Петербург": 2, "Сибирь": 3, "Урал": 4, "Центр": 5, "Юг": 6, "ДМФ": 8, "ММФ": 9,
}
NO_DIVISION = 7
TRANSPORTS = {"Велосипед": 1, "Авто": 2, "Мото": 3, "Пеший": 4}
ROLES = {
    "Вело курьер": 4, "Курьер-электровело": 4, "Авто-курьер": 1, "Сборщик": 3, "Мото-курьер": 7,
}
RESOURCES = {"Курьер (кол-во)": 1, "Пикер (кол-во)": 2}
STORE_PREFIX = "ТК"

# Formats of dates and times in cells.
DATES = ("yyyy/M/d", "d.M.yy", "yyyy-M-d HH:mm:ss", "yyyy-M-d")
TIMES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm:ss")
