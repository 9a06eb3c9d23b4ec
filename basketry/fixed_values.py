"""Rename rules applied to the aggregate and fact tables, in this order."""

# Product renames, (old name, new name).
PRODUCT_RENAMES = [
    ("Cadbury Dairy Milk Silk Fruit & Nut Chocolate Bar 55g", "Cadbury Dairy Milk Silk Fruit & Nut Chocolate 55g"),
    ("Ocean Peach & Passion Fruit Flavour Fruit Drink 500 ml", "Ocean Peach & Passion Fruit Fruit Drink 500 ml"),
    ("Lotus Biscoff Original Caramelised Biscuit - 250 gm", "Lotus Biscoff Original Biscuit-250 gm"),
    ("Labubu Have A Seat Original Popmart The Monsters Blind", "Labubu Have A Seat Original Monsters Blind"),
    ("Kwality Wall's Magnum Chocolate Truffle Ice Cream 70ml", "Kwality Wall's Magnum Chocolate Ice Cream 70ml"),
    ("Cadbury Dairy Milk Silk Fruit & Nut Chocolate Bar 137g", "Cadbury Dairy Milk Silk Fruit & Nut Bar 137g"),
    ("Nutella & Go Hazelnut Spread & Pretzels Sticks, 48gm", "Nutella & Go Hazelnut Spread & Pretzels 48gm"),
    ("Coca Cola Diet Coke Carbonated Soft Drink Can 300ml", "Coca Cola Diet Coke Carbonated Soft Drink 300ml"),
    ("Coca Cola Soft Drink Original Taste, Refreshing, 1L ", "Coca Cola Soft Drink Original Taste, 1L "),
    ("Ocean Strawberry & Lime Flavour Fruit Drink 500 ml", "Ocean Strawberry & Lime Flavour Drink 500 ml "),
    ("Cadbury Dairy Milk Silk Roast Almond Chocolate Bar 58g", "Cadbury Dairy Milk Silk Roast Almond Chocolate 58g"),
    ("Cadbury Celebrations Assorted Chocolate Gift Pack 154.2g ", "Cadbury Celebrations Assorted Chocolate 154.2g"),
    ("Godiva Chocolate Milk Chocolate Hazelnut Oyster 83 G", "Godiva Chocolate Milk Chocolate Hazelnut 83g"),
    ("Cadbury Dairy Milk Silk Roast Almond Chocolate 58g", "Cadbury Dairy Milk Silk Roast Almond Choco 58g"),
    ("Cadbury Dairy Milk Silk Hazelnut Chocolate Bar 58g", "Cadbury Dairy Milk Silk Hazelnut Chocolate 58g"),
    ("MR. MAKHANA Popped Lotus Seeds - Pudina Party 75 g", "MR. MAKHANA Popped Lotus Seeds-Pudina Party 75g"),
    ("Coca Cola Diet Coke Carbonated Soft Drink 300ml", "Coca Cola Diet Coke Carbonated Drink 300ml"),
    ("Cadbury Dairy Milk Silk Bubbly Chocolate Bar 112g", "Cadbury Dairy Milk Silk Chocolate Bar 112g"),
    ("Catch Flavoured Water - Lemon N Lime 750 Ml Bottle", "Catch Flavoured Water - Lemon N Lime 750 Ml"),
    ("MrBeast Feastables Almond Milk Chocolate with Almond Chunks Bar 60g", "MrBeast Almond Chocolate with Almond 60g"),
    ("Samyang Hot Chicken Flavor Ramen Buldak Carbonara Noodles 650Gm ", "Samyang Chicken Flavor Ramen Buldak Noodles 650Gm"),
    ("Parle Platina Hide & Seek Chocolate Chip Cookies - 100gm", "Parle Platina Hide & Seek Chocolate Cookies-100gm"),
    ("Monster Energy Drink Ultra Zero Sugar 12 x 500ml", "Monster Energy Drink Zero Sugar 12 x 500ml"),
    ("Nestle Munch Max Chocolate Coated Crunchy Wafer Bar 38.5g", "Nestle Munch Max Chocolate Coated Wafer 38.5g"),
    ("RiteBite Max Protein Bar Ultimate Choco Berry 100g", "RiteBite Max Protein Bar Ultimate Choco 100g"),
    ("Sprite Clear Carbonated Drink Pet Bottle 750ml", "Sprite Clear Carbonated Drink Bottle 750ml"),
    ("Catch Flavoured Water - Black Currant 750 Ml Bottle", "Catch Flavoured Water - Black Currant 750 Ml"),
    ("Coca Cola Soft Drink Original Taste, Refreshing, 750Ml", "Coca Cola Soft Drink Original Taste 750Ml"),
    ("Cadbury Dairy Milk Silk Fruit & Nut Chocolate 55g", "Cadbury Dairy Milk Silk Fruit & Nut 55g"),
    ("iteBite Max Protein Bar Ultimate Choco Almond 30g", "iteBite Max Protein Bar Choco Almond 30g"),
    ("Epigamia Chocolate Turbo 25 g Protein Milkshake, 250 ml", "Epigamia Chocolate Protein Milkshake, 250 ml"),
    ("Mr Makhana Himalaya Salt & Pepper Popped Lotus Seeds 60g", "Mr Makhana Himalaya Lotus Seeds 60g"),
    ("Cadbury Dairy Milk Silk Fruit & Nut Chocolate Bar 51 g", "Cadbury Dairy Milk Fruit & Nut Chocolate 51 g"),
    ("RiteBite Max Protein Bar Ultimate Choco Almond 30g", "RiteBite Max Protein Bar Choco Almond 30g"),
    ("Toblerone Swiss Milk Chocolate - With Honey & Almond Nougat, 100gm", "Toblerone Swiss Milk Chocolate-Honey Almond 100gm"),
    ("Cetaphil Sun Pff 50+ Light Gel Sensitive Skin Body 50 Ml", "Cetaphil Sun Pff 50+ Light Gel Skin Body 50 Ml"),
    ("MrBeast Feastables Crunch Milk Chocolate with Puffed Rice Bar 60g", "MrBeast Feastables Milk Chocolate Rice Bar 60g"),
]
# Store renames, (old name, new name).
STORE_RENAMES = [("Daryaganj Netaji Subhash Marg", "Daryaganj Subhash Marg")]
# End of fixed values.
