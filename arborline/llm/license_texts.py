"""What licence notices say: fixed values of the licence scan. All are public notices, in their usual wording."""

from __future__ import annotations

#: Names by which works name their licence. A text that names one so holds every word of it, in order.
NAMES = {
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache License v2.0", "Apache-2.0 license", "SPDX-License-Identifier: Apache-2.0", "Apache-2.0", "Apache-2.0 OR MIT", "MIT OR Apache-2.0"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "3-Clause BSD License", "2-Clause BSD License", "BSD-style license", "BSD License", "New BSD License", "Simplified BSD License",
            "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause", "BSD-3-Clause license", "BSD-2-Clause license", "BSD-3-Clause", "BSD-2-Clause"),
    "cc-by-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0", "SPDX-License-Identifier: CC-BY-4.0", "CC-BY-4.0"),
    "cc-by-nc-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons Attribution-Non-Commercial 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc-by-sa-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0", "Creative Commons Attribution-Share Alike 4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "cc0-1.0": ("CC0 1.0 Universal", "Creative Commons CC0 1.0", "Creative Commons Zero 1.0", "CC0 1.0 license", "CC0 1.0", "CC0 public domain dedication", "SPDX-License-Identifier: CC0-1.0"),
    "gpl-3.0": ("GNU General Public License, version 3", "GNU General Public License v3", "GNU General Public License v3.0", "GNU GPL version 3", "GNU GPL v3", "GNU GPLv3", "GPL version 3", "GPLv3", "GPL v3",
                "GPL-3.0 license", "GPL-3.0", "GPL-3.0-or-later", "GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "lgpl-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "GNU LGPL version 3", "GNU LGPLv3", "LGPLv3", "LGPL v3", "SPDX-License-Identifier: LGPL-3.0-only",
                 "SPDX-License-Identifier: LGPL-3.0-or-later"),
    "mit": ("MIT License", "MIT licensed", "The MIT License (MIT)", "MIT-style license", "licensed under MIT", "licensed MIT", "MIT or Apache", "Apache or MIT", "Apache-2.0 OR MIT", "MIT OR Apache-2.0", "SPDX-License-Identifier: MIT"),
    "mpl-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0 license", "MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
}

#: Passages of licences and of their usual headers: (text, n-grams it must hold). A passage may lose a fifth of its n-grams.
PASSAGES = {
    "apache-2.0": (
        ("you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("license 2 0",)),
        ("you may not use this file except in compliance with the License", ()),
        ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND", ()),
    ),
    "bsd": (
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ()),
        ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", ()),
        ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution", ()),
        ("Redistributions of source code must retain the above copyright notice", ()),
        ("Redistributions in binary form must reproduce the above copyright notice", ()),
        ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES", ()),
        ("THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED", ()),
        ("IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES", ()),
        ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ()),
    ),
    "cc-by-4.0": (("You are free to share and adapt the material under the Creative Commons Attribution 4.0 International License", ("attribution 4 0",)),),
    "cc-by-nc-4.0": (("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("noncommercial 4 0",)),),
    "cc-by-sa-4.0": (("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("sharealike 4 0",)),),
    "cc0-1.0": (
        ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ()),
        ("The person who associated a work with this deed has dedicated the work to the public domain by waiving all of their rights to the work worldwide under copyright law", ()),
    ),
    "gpl-3.0": (
        ("redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", ("version 3 of", "gnu general public")),
        ("Released under the terms of the GNU General Public License version 3 or any later version", ("license version 3", "gnu general public")),
    ),
    "lgpl-3.0": (("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License", ("version 3 of", "gnu lesser general")),),
    "mit": (
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction", ()),
        ("including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ()),
        ("THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT", ()),
        ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE", ()),
        ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", ()),
    ),
    "mpl-2.0": (
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("v 2 0",)),
        ("If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", ("mpl 2 0",)),
    ),
}

#: Licences and grants of rights that belong to none of the families.
OTHER_LICENSES = (
    "ISC License", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "provided that the above copyright notice and this permission notice appear in all copies",
    "zlib License", "This software is provided as is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software",
    "Boost Software License, Version 1.0", "Eclipse Public License v2.0", "Eclipse Public License, version 1.0", "Artistic License 2.0", "Academic Free License version 3.0", "European Union Public License 1.2", "Python Software Foundation License Version 2",
    "The Unlicense", "This is free and unencumbered software released into the public domain", "Do What The Fuck You Want To Public License", "GNU Free Documentation License, Version 1.3", "GNU General Public License version 2", "GNU General Public License v2",
    "GNU Affero General Public License version 3", "GNU AGPLv3", "GNU Lesser General Public License version 2.1", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License",
    "Apache License, Version 1.1", "Mozilla Public License, version 1.1", "Creative Commons Attribution 3.0", "CC BY-SA 3.0", "CC BY-ND 4.0", "CC BY-NC-ND 4.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NoDerivatives 4.0", "Open Database License 1.0", "SIL Open Font License, Version 1.1",
    "Licensed under a proprietary commercial agreement", "This license is granted to one user only", "Licensed under the terms of the owner", "Copyright by the authors, no license is given", "All rights reserved. Unauthorized copying of this file is strictly prohibited",
    "Licensed Materials, property of the company", "This software is proprietary and confidential", "The license agreement governs your use of the software", "You may not reverse engineer, rent, lease or lend the software",
    "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE", "You should have received a copy of the GNU General Public License along with this program",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. See the GNU General Public License for more details", "licensed under the terms of a separate agreement", "this license does not grant any right to use the trademarks",
    "Business Source License 1.1", "Server Side Public License, version 1", "Elastic License 2.0", "distributed under the license terms of the vendor", "subject to the license terms set out below", "see the LICENSE file for details",
)

#: Sentences that license nothing.
NO_LICENSE = (
    "He got his license to drive in 2010", "Doctors are licensed by the state", "Her license expired last year", "The nurse renewed her license with the board", "A pilot license takes a year", "They sell beer on licensed premises", "The officer asked for license and registration",
    "The state may revoke a license to practice law", "A marriage license was signed in the church", "Poetic license lets a writer bend the truth", "The television license is paid once a year", "The hunting license is valid for two years", "Taxi drivers are licensed by the city", "The bank was licensed in 1990",
    "A driving license is required for this job", "The license plate was found on the road", "Released under the open sky", "The work is in the public library", "He was licensed to sell wine", "The general public may use this version of the road",
    "Version 2.0 was released in May", "See the file for the source of the river", "Creative people work in common rooms", "Released under the new law after two years", "The public house lost its license to sell beer", "A licensed electrician must do the work",
    "The fishing license fee was paid", "She has a license to fly", "The mit fits the hand of the catcher", "Students at MIT and Harvard met in the spring", "The apache people lived in the southwest", "The gnu is an animal of the plains", "Mozilla was a company with an office by the bay",
    "Permission is required to enter the building", "Neither the name nor the address was known", "The following conditions are met in the desert", "The above notice was sent to all persons", "Copies of the letter were sold", "The software was used to copy files",
    "They share a common border and creative ideas", "The attribution of the painting is not certain", "Public records are kept in the general archive", "The terms of the treaty were published", "It will be useful, but it comes without any promise", "Free of charge for any person under ten",
    "The foundation gave free software to the school", "In the public domain of politics such words are rare", "The source of the river is in the hills", "Use of the hall is subject to the following rules", "The bsd meeting starts at nine", "Warranty claims are handled by the shop",
    "The merchant sold goods of any kind", "You may obtain a copy of the map at the gate", "Distribution of food was limited", "The rights of the child are protected by law", "Version 3 of the plan is better", "The clause was dropped from the contract", "An agreement in writing is needed",
)

#: Words that occur everywhere; an n-gram of these and of digits alone is no feature.
STOP_WORDS = frozenset("a an and any are as at be but by can for from has have he if in is it its may no not of on or our she so such that the their they this to under was were which will with you your".split())

#: What probabilities are calibrated on: notices and other sentences that are none of the texts above. (text, family, or "unknown" or "none").
CALIBRATION = (
    ("Everything in this folder falls under the Apache License, Version 2.0, a copy of which is in the root.", "apache-2.0"), ("license = Apache-2.0", "apache-2.0"), ("You may use it subject to the Apache 2.0 License", "apache-2.0"),
    ("The parser's terms are those of the New BSD License.", "bsd"), ("license: BSD-3-Clause", "bsd"), ("Licensed to the world under the Simplified BSD License (see below)", "bsd"), ("Text and pictures: CC BY 4.0, by the editors", "cc-by-4.0"),
    ("Reuse of the map is allowed under Creative Commons Attribution 4.0 with credit to us", "cc-by-4.0"), ("For teaching only, CC BY-NC 4.0", "cc-by-nc-4.0"), ("The recordings carry the licence Creative Commons Attribution-NonCommercial 4.0", "cc-by-nc-4.0"),
    ("Our wiki is shared as CC BY-SA 4.0", "cc-by-sa-4.0"), ("Creative Commons Attribution-ShareAlike 4.0 covers the glossary", "cc-by-sa-4.0"), ("The numbers are given away as CC0 1.0", "cc0-1.0"), ("Data: CC0 1.0 Universal, no conditions", "cc0-1.0"),
    ("You may copy the tool as the GNU General Public License, version 3 allows", "gpl-3.0"), ("Plugins must be GPLv3 as well", "gpl-3.0"), ("license: GPL-3.0-or-later", "gpl-3.0"), ("The bindings come as LGPLv3", "lgpl-3.0"), ("Linking is allowed by the GNU Lesser General Public License v3", "lgpl-3.0"),
    ("The whole thing is MIT licensed, do as you like", "mit"), ("See MIT License in the appendix", "mit"), ("Dual: MIT OR Apache-2.0 at your option", "mit"), ("Files in core fall under the Mozilla Public License 2.0", "mpl-2.0"), ("the engine, MPL 2.0, and its tests", "mpl-2.0"),
    ("The vendor's own license terms apply to the drivers", "unknown"), ("Licensed under the Common Development and Distribution License", "unknown"), ("This edition is licensed for personal use at home", "unknown"), ("Permission to quote is granted to reviewers", "unknown"),
    ("Redistribution is not permitted without our consent", "unknown"), ("Fonts: SIL Open Font License, Version 1.1, see there", "unknown"), ("All rights reserved by the heirs; copying is prohibited", "unknown"), ("GNU General Public License version 2 only", "unknown"),
    ("The dentist keeps her license on the wall", "none"), ("Drivers without a license pay a fine", "none"), ("The software of the ticket machine was replaced in 2012", "none"), ("Version 3 of the draft was read to the members", "none"), ("The public may visit the works on Sunday", "none"),
    ("A common creative mind is rare", "none"), ("The council granted permission for the fair", "none"), ("Copies of the notice hung in every shop", "none"), ("She studied at MIT before the war", "none"), ("The apache helicopter landed at noon", "none"), ("Nothing of the kind was promised by the merchant", "none"),
    ("The source of the file was an old archive", "none"), ("Terms and conditions of the sale were read aloud", "none"), ("His plumber is licensed and insured", "none"),
)
