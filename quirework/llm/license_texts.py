"""Templates of the licence scan: whole short licences, and the notices and opening words of long ones."""

_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_MIT_TERMS = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD_TWO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_ADS = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
_BSD_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TERMS = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_GNU_AS_IS = "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"


def _gnu(thing: str, licence: str, version: str, mark: str) -> list[str]:
    """The notice of a GNU licence: its grant, and the grant with the warranty paragraph."""
    grant = f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {licence} as published by the Free Software Foundation{',' if mark == ':' else ';'} either version {version} of the License, or (at your option) any later version."
    return [grant, f"{grant} This {thing} {_GNU_AS_IS} {licence} for more details."]


def _cc(code: str, words: str) -> list[str]:
    return [f"Licensed under {code} 4.0.", f"This work is licensed under a Creative Commons {words} 4.0 International License."]


TEMPLATES = {
    "0BSD": [f"{_ISC_GRANT}. {_ISC_AS_IS}"],
    "AGPL-3.0": [*_gnu("program", "Affero General Public License", "3", ":"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "Artistic-2.0": [
        "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed. This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed.",
    ],
    "BSD-2-Clause": [_BSD_TWO, f"{_BSD_TWO} {_BSD_AS_IS}"],
    "BSD-3-Clause": [f"{_BSD_TWO} {_BSD_NAMES}", f"{_BSD_TWO} {_BSD_NAMES} {_BSD_AS_IS}"],
    "BSD-4-Clause": [f"{_BSD_TWO} {_BSD_ADS} {_BSD_NAMES}", f"{_BSD_TWO} {_BSD_ADS} {_BSD_NAMES} {_BSD_AS_IS}"],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        'Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.',
    ],
    "CC-BY-4.0": _cc("CC BY", "Attribution"),
    "CC-BY-NC-4.0": _cc("CC BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _cc("CC BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("CC BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _cc("CC BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _cc("CC BY-SA", "Attribution-ShareAlike"),
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Licensed under CC0 1.0 Universal."],
    "CDDL-1.0": [
        'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License"). You may not use this file except in compliance with the License. See the License for the specific language governing permissions and limitations under the License.'
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        'THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT\'S ACCEPTANCE OF THIS AGREEMENT.',
    ],
    "EUPL-1.2": ['Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the "Licence"); You may not use this work except in compliance with the Licence.'],
    "GPL-2.0": [*_gnu("program", "General Public License", "2", ";"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", *_gnu("program", "General Public License", "3", ":"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "ISC": [f"{_ISC_GRANT}{_ISC_TERMS}", f"{_ISC_GRANT}{_ISC_TERMS} {_ISC_AS_IS}"],
    "LGPL-2.1": [*_gnu("library", "Lesser General Public License", "2.1", ";"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": [*_gnu("program", "Lesser General Public License", "3", ":"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", f"{_MIT_GRANT}{_MIT_TERMS}", f"{_MIT_GRANT}{_MIT_TERMS} {_MIT_AS_IS}"],
    "MIT-0": [f"{_MIT_GRANT}. {_MIT_AS_IS}"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ],
    "WTFPL": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
    ],
}
