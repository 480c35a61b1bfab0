"""Display names of product categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.text import title_case

# Vietnamese display name of each English category.
VIETNAMESE_NAMES = {
    "health_beauty": "Sức khoẻ & Làm đẹp",
    "watches_gifts": "Đồng hồ & Quà tặng",
    "bed_bath_table": "Giường, Phòng tắm & Bàn",
    "sports_leisure": "Thể thao & Giải trí",
    "computers_accessories": "Máy tính & Phụ kiện",
    "furniture_decor": "Nội thất & Trang trí",
    "housewares": "Đồ gia dụng",
    "cool_stuff": "Đồ hay",
    "garden_tools": "Dụng cụ vườn",
    "auto": "Ô tô & Phụ tùng",
    "toys": "Đồ chơi",
    "baby": "Đồ trẻ em",
    "perfumery": "Nước hoa",
    "telephony": "Điện thoại",
    "stationery": "Văn phòng phẩm",
    "electronics": "Điện tử",
    "fashion_bags_accessories": "Túi & Phụ kiện thời trang",
    "fashion_shoes": "Giày đẹp",
    "fashion_underwear_beach": "Đồ lót & đồ bơi",
    "fashion_sport": "Thời trang thể thao",
    "consoles_games": "Máy chơi game",
    "audio": "Âm thanh",
    "food_drink": "Thực phẩm & Đồ uống",
    "books_general_interest": "Sách tổng hợp",
    "books_technical": "Sách kỹ thuật",
    "books_imported": "Sách nhập khẩu",
    "construction_tools_construction": "Dụng cụ xây dựng",
    "construction_tools_safety": "Dụng cụ an toàn",
    "costruction_tools_tools": "Bộ dụng cụ xây dựng",
    "construction_tools_lights": "Đèn xây dựng",
    "small_appliances": "Thiết bị gia dụng nhỏ",
    "small_appliances_home_oven_and_coffee": "Lò & máy pha cà phê",
    "pet_shop": "Thú cưng",
    "office_furniture": "Nội thất văn phòng",
    "industry_commerce_and_business": "Công nghiệp & thương mại",
    "fixed_telephony": "Điện thoại bàn",
    "luggage_accessories": "Hành lý & phụ kiện",
    "air_conditioning": "Điều hòa",
    "kitchen_dining_laundry_garden_furniture": "Nội thất bếp & vườn",
    "musical_instruments": "Nhạc cụ",
    "signaling_and_security": "An ninh & bảo hiểm",
    "computers": "Máy tính",
    "christmas_supplies": "Đồ giáng sinh",
    "home_appliances": "Thiết bị gia dụng",
    "home_appliances_2": "Thiết bị gia dụng 2",
    "home_comfort": "Tiện nghi gia đình",
    "home_comfort_2": "Tiện nghi gia đình 2",
    "home_confort": "Tiện nghi gia đình",
    "flowers": "Hoa",
    "market_place": "Sàn thương mại",
    "diapers_and_hygiene": "Tã & vệ sinh",
    "drinks": "Đồ uống",
    "food": "Thực phẩm",
    "tablets_printing_image": "Máy tính bảng & in ấn",
    "cds_dvds_musicals": "CD/DVD/Nhạc",
    "arts_and_craftmanship": "Nghệ thuật & thủ công",
    "la_cuisine": "Nhà bếp",
    "furniture_living_room": "Nội thất phòng khách",
    "furniture_bedroom": "Nội thất phòng ngủ",
    "furniture_mattress_and_upholstery": "Nệm & bọc ghế",
    "agro_industry_and_commerce": "Nông nghiệp & thương mại",
    "party_supplies": "Đồ tiệc",
    "security_and_services": "An ninh & Dịch vụ",
    "fashion_male_clothing": "Thời trang nam",
    "fashion_female_clothing": "Thời trang nữ",
    "fashion_childrens_clothes": "Thời trang trẻ em",
    "cine_photo": "Phim & ảnh",
    "home_construction": "Xây dựng nhà",
}
UNKNOWN = {"vi": "Khong xac dinh", "en": "Unknown"}


def with_display_name(df: DataFrame, column: str, name: str = "display_name", language: str = "vi") -> DataFrame:
    """Add the name shown to users; a category without a translation is shown in title case.

    The lookup is the constant table above, so its broadcast has a fixed size.
    """
    fallback = F.coalesce(title_case(F.col(column)), F.lit(UNKNOWN[language]))
    if language == "en":
        return df.withColumn(name, fallback)
    names = df.sparkSession.createDataFrame(list(VIETNAMESE_NAMES.items()), f"{column} string, _translated string")
    joined = df.join(F.broadcast(names), column, "left")
    return joined.withColumn(name, F.coalesce("_translated", fallback)).drop("_translated")
