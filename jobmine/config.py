"""Settings shared by the operators and the end-to-end plans."""

from __future__ import annotations

from dataclasses import dataclass

# Column roles of a postings table.
TEXT_COLUMNS = (
    "job_title", "company_name", "location", "job_type", "job_industry",
    "experience_level", "education_level", "job_position",
    "job_description", "benefits", "requirements",
)
LONG_TEXT_COLUMNS = ("job_description", "benefits", "requirements")
LENGTH_COLUMNS = ("job_title", "job_description", "benefits", "requirements", "location")
CATEGORICAL_COLUMNS = (
    "job_type", "job_industry", "experience_level", "education_level", "job_position", "location",
)
CATEGORICAL_METADATA = (
    "job_type", "job_industry", "experience_level", "education_level", "job_position",
    "location_simplified",
)
BASE_NUMERIC = (
    "salary_expected_million_vnd", "salary_range_width", "salary_min", "salary_max",
    "is_salary_outlier",
)
TEXT_LENGTHS = (
    "job_description_length", "requirements_length", "benefits_length", "final_text_length",
)
FEATURE_TEXT_COLUMNS = ("job_title", "job_description", "requirements", "benefits")
NEAR_DUPLICATE_KEY = ("job_title", "company_name", "location", "salary")
METADATA_COLUMNS = (
    "id", "job_title", "company_name", "location", "location_simplified", "job_industry",
    "job_type", "experience_level", "education_level", "job_position",
    "salary_expected_million_vnd", "salary_range_width", "salary_min", "salary_max",
    "is_salary_outlier", "final_text",
)
PROFILE_COLUMNS = (
    "job_title", "job_industry", "experience_level", "education_level", "job_position",
    "job_type", "location_simplified",
)
DEMO_COLUMNS = (
    "job_title", "salary", "salary_expected_million_vnd", "job_industry", "experience_level",
    "education_level", "job_position", "job_type", "location", "location_simplified",
    "cluster_id", "cluster_label",
)

# Words that make a pay text ambiguous (substring match on folded text).
AMBIGUOUS_KEYWORDS = (
    "thoa thuan", "thương lượng", "thuong luong", "canh tranh", "cạnh tranh", "negotiable",
    "deal luong", "dang cap nhat", "đang cập nhật", "updating", "update", "competitive",
)

# City groups, in matching order.
LOCATION_GROUPS = (
    ("ho chi minh", ("ho chi minh", "tphcm", "tp.hcm", "hcm", "sai gon")),
    ("ha noi", ("ha noi", "hn")),
    ("da nang", ("da nang",)),
    ("binh duong", ("binh duong",)),
    ("dong nai", ("dong nai",)),
    ("hai phong", ("hai phong",)),
    ("can tho", ("can tho",)),
    ("bac ninh", ("bac ninh",)),
)

# Stop phrases; they are cut into words before use.
STOP_PHRASES = (
    "rat", "su", "moi", "lam", "de", "neu", "nen", "dang", "da", "se", "tai", "qua", "ve", "hoac",
    "theo", "nhu", "cung", "nhieu", "den", "tu", "khac", "dam bao", "thuc hien", "khong", "cho",
    "khi", "nhung", "trong", "voi", "duoc", "cua", "cac", "co", "va", "cong viec", "chi tiet",
    "trao doi", "phong van", "che do", "day du", "tham gia", "bao hiem", "moi truong", "nang dong",
    "than thien", "chuyen nghiep", "trach nhiem", "nhanh nhen", "ky nang", "yeu cau", "kinh nghiem",
    "ung vien", "tot", "quyen loi", "huong", "luong", "thuong", "co hoi", "phat trien", "cong ty",
    "quy dinh", "nhan vien", "khach hang", "lien he", "ho tro", "lam viec",
)

# Labels given by hand to the clusters of the 13-cluster model.
CLUSTER_LABELS_13 = {
    0: "IT - phần mềm - kinh doanh/marketing chuyên môn",
    1: "Kỹ thuật - sản xuất - bảo trì",
    2: "Kinh doanh - bán hàng - chăm sóc khách hàng",
    3: "Kho vận - giao nhận - lao động phổ thông",
    4: "Marketing - nội dung - thiết kế",
    5: "Hành chính nhân sự - văn phòng - xuất nhập khẩu",
    6: "Bán lẻ - dịch vụ - lao động phổ thông",
    7: "Tư vấn giáo dục - quản lý trung tâm",
    8: "Kế toán - kiểm toán - tài chính doanh nghiệp",
    9: "Tài chính - ngân hàng - thu hồi/nhắc phí",
    10: "Xây dựng - kiến trúc - kỹ thuật công trình",
    11: "Telesales - tư vấn qua điện thoại",
    12: "Giáo dục - đào tạo - giáo viên ngoại ngữ",
}

# Labels given by hand to the clusters of the 12-cluster model.
CLUSTER_LABELS_12 = {
    0: "Bán lẻ - dịch vụ - lao động phổ thông",
    1: "Chăm sóc khách hàng - tư vấn giáo dục",
    2: "Kỹ thuật - sản xuất - bảo trì",
    3: "Kinh doanh - bán hàng - phát triển thị trường",
    4: "Chuyên viên kinh doanh - phát triển khách hàng",
    5: "Kế toán - kiểm toán - tài chính doanh nghiệp",
    6: "Hành chính nhân sự - văn phòng - xuất nhập khẩu",
    7: "Xây dựng - kiến trúc - kỹ thuật công trình",
    8: "Bán hàng cửa hàng - quản lý khu vực",
    9: "Telesales - tư vấn khách hàng",
    10: "Tài chính - ngân hàng - tư vấn pháp lý",
    11: "Marketing - truyền thông - thiết kế",
}


@dataclass(frozen=True)
class Settings:
    """Defaults of the end-to-end plans; every value can be overridden."""

    usd_to_vnd: float = 25_000.0
    test_share: float = 0.1
    seed: int = 42
    n_bins: int = 10
    remove_salary_mentions: bool = False
    dedup: bool = True
    min_df: int = 20
    max_df: float = 0.40
    vocabulary_size: int = 30_000
    ngram_max: int = 3
    svd_components: int = 300
    low_dim: int = 10
    eval_sample: int = 10_000
    fit_sample: int | None = None
    k_values: tuple[int, ...] = (10, 12, 13, 14)
    final_k: int = 13
    restarts: int = 10
    max_iter: int = 300
    minibatch_size: int = 4_096
    minibatch_steps: int = 100
