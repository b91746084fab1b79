"""Fixed values of the shop: domains, codes and rule names."""

# They must equal the ones users already have in their data.
CATEGORIES = [
    "Alimentos",
    "Beleza",
    "Brinquedos",
    "Casa",
    "Eletrônicos",
    "Esporte",
    "Jardim",
    "Livros",
    "Moda",
    "Papelaria",
    "Pet",
    "Tecnologia",
]
FUNNEL_STEPS = ["page_view", "view_product", "add_to_cart", "checkout", "purchase"]
SHIPMENT_STATUSES = ["pending", "in_transit", "delivered", "returned"]
COURSE_NAMES = {
    "BSI": "SISTEMAS DE INFORMAÇÃO",
    "Sistemas de Informacao": "SISTEMAS DE INFORMAÇÃO",
}
MODAL_SPELLING = {"Onibus": "ônibus"}
FAR_FUTURE = "9999-12-31"
